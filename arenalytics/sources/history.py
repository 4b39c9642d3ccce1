"""The history of loaded match ids, stored in buckets of the id.

Insert-if-absent looks up every id of a batch among all ids ever loaded.  The
ids are kept apart from the matches in a bucketed, sorted table: a join on the
id reads it bucket by bucket and moves only the batch, whatever the history's
size.  A batch appends one file per bucket.

The matches are the commit, the history follows them.  Every load writes its
ids under a name of its own (``attempt``), and a mark names the attempt that
holds for a batch once its ids are in place.  Ids of other attempts are not
read; a committed batch without a mark (the load ended between the two) gets
its ids from the matches when the history is next opened.
"""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HISTORY_BUCKETS = 32        # a table keeps the number it was made with: it is part of its folder's name

Batch = tuple[str, int]


def _fs(spark: SparkSession, path: str):
    """(file system, path class): the cluster's Hadoop client."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path
    return p(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p(path))


def _below(spark: SparkSession, pattern: str) -> list[str]:
    fs, p = _fs(spark, pattern)
    return [f.getPath().toString() for f in fs.globStatus(p(pattern)) or []]


def committed_batches(spark: SparkSession, matches: str) -> list[Batch]:
    """The batches whose matches are written (their partition folders)."""
    out = []
    for path in _below(spark, os.path.join(matches, "run_id=*", "batch_id=*")):
        run, batch = path.rstrip("/").rsplit("/", 2)[1:]
        out.append((run.split("=", 1)[1], int(batch.split("=", 1)[1])))
    return out


class MatchHistory:
    """The ids of the sink below ``root``, whose matches are in ``matches``."""

    def __init__(self, spark: SparkSession, root: str, matches: str, buckets: int = HISTORY_BUCKETS):
        self.spark, self.matches, self.buckets = spark, matches, buckets
        self.path = os.path.join(root, f"history_{buckets}")
        self.marks = os.path.join(root, f"history_{buckets}_marks")
        self.table = "match_history_" + hashlib.md5(self.path.encode()).hexdigest()[:16]
        fs, p = _fs(spark, self.path)
        fs.mkdirs(p(self.path))
        spark.sql(f"""CREATE TABLE IF NOT EXISTS {self.table} (match_id STRING, attempt STRING)
            USING parquet CLUSTERED BY (match_id) SORTED BY (match_id) INTO {buckets} BUCKETS
            LOCATION '{self.path}'""")

    def _marked(self) -> dict[Batch, list[str]]:
        out: dict[Batch, list[str]] = {}
        for path in _below(self.spark, os.path.join(self.marks, "*", "*", "*")):
            run, batch, attempt = path.rstrip("/").rsplit("/", 3)[1:]
            out.setdefault((run, int(batch)), []).append(attempt)
        return out

    def _mark_folder(self, batch: Batch) -> str:
        return os.path.join(self.marks, batch[0], str(batch[1]))

    def forget(self, batch: Batch) -> None:
        """Before a batch is written (again): its ids no longer hold."""
        fs, p = _fs(self.spark, self.marks)
        fs.delete(p(self._mark_folder(batch)), True)

    def append(self, batch: Batch, ids: DataFrame) -> None:
        """The ids of a committed batch."""
        attempt = uuid.uuid4().hex
        (ids.select("match_id", F.lit(attempt).alias("attempt"))
            .repartition(self.buckets, "match_id").sortWithinPartitions("match_id")
            .write.insertInto(self.table))
        fs, p = _fs(self.spark, self.marks)
        fs.mkdirs(p(os.path.join(self._mark_folder(batch), attempt)))

    def recover(self) -> None:
        """Ids of committed batches whose load ended before they were stored."""
        marked = self._marked()
        for run, number in committed_batches(self.spark, self.matches):
            if (run, number) not in marked:
                own = self.spark.read.parquet(self.matches).filter(
                    (F.col("run_id") == run) & (F.col("batch_id") == number))
                self.append((run, number), own)

    def ids(self, but: Batch | None = None) -> DataFrame:
        """The loaded ids, except those of the batch ``but``; a scan by bucket."""
        self.recover()
        self.spark.catalog.refreshTable(self.table)
        holding = [a for b, attempts in self._marked().items() if b != but for a in attempts]
        # one name per batch: the list is as long as the number of loads
        names = F.split(F.lit(",".join(holding)), ",")
        valid = self.spark.range(0, 1, 1, 1).select(F.explode(names).alias("attempt"))
        return self.spark.table(self.table).join(F.broadcast(valid), "attempt", "left_semi").select("match_id")
