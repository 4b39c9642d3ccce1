"""A Parquet table whose live files are named by a manifest.

``DELETE … WHERE column = value`` on a large table should not rewrite it.  Here
the scan names the files that hold the key — the filter is pushed down, so row
groups whose statistics exclude it are not read — and only these are rewritten
without the rows; all others stay as they are, under their names.  The next
manifest replaces the old names by the new ones; it appears by one rename, so a
reader sees the table before the delete or after it.

Stored sorted by the columns that deletes and filters name
(``write_layer(cluster_by=…)``), a key lies in few files.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .history import _below, _fs
from .tables import write_layer

MANIFESTS = "manifests"


class FileTable:
    """The table in the folder ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _manifests(self) -> list[tuple[int, str]]:
        found = _below(self.spark, os.path.join(self.path, MANIFESTS, "[0-9]*"))
        return sorted((int(f.rsplit("/", 1)[1]), f) for f in found)

    def files(self) -> list[str]:
        """The live files, relative to the folder."""
        manifests = self._manifests()
        if not manifests:
            return []
        rows = self.spark.read.format("text").load(manifests[-1][1]).collect()
        return sorted(r.value for r in rows if r.value)

    def _publish(self, files: list[str]) -> None:
        fs, p = _fs(self.spark, self.path)
        number = (self._manifests()[-1][0] if self._manifests() else 0) + 1
        draft = p(os.path.join(self.path, MANIFESTS, f"draft-{uuid.uuid4().hex}"))
        out = fs.create(draft)
        out.write(bytearray("\n".join(files).encode()))
        out.close()
        if not fs.rename(draft, p(os.path.join(self.path, MANIFESTS, str(number)))):
            raise RuntimeError(f"another change of {self.path} came first")

    def _add(self, df: DataFrame, **layout) -> list[str]:
        part = f"d{uuid.uuid4().hex}"
        write_layer(df, os.path.join(self.path, part), **layout)
        found = _below(self.spark, os.path.join(self.path, part, "*.parquet"))
        return [f"{part}/{f.rsplit('/', 1)[1]}" for f in found]

    def write(self, df: DataFrame, cluster_by: list[str] | None = None) -> None:
        """Replace the table by ``df``."""
        self._publish(self._add(df, cluster_by=cluster_by))

    def read(self) -> DataFrame:
        files = self.files()
        if not files:
            raise LookupError(f"no table in {self.path}")
        return self.spark.read.parquet(*[os.path.join(self.path, f) for f in files])

    def holding(self, condition: Column) -> list[str]:
        """The live files with a row for which ``condition`` is true."""
        rows = self.read().filter(condition).select(F.col("_metadata.file_path").alias("f")).distinct().collect()
        return sorted("/".join(r.f.rsplit("/", 2)[1:]) for r in rows)

    def delete(self, condition: Column) -> list[str]:
        """Delete the rows for which ``condition`` is true (not false or null);
        returns the files that were rewritten.  Their old versions stay for
        running readers until ``vacuum``."""
        touched = self.holding(condition)
        if touched:
            rest = self.spark.read.parquet(*[os.path.join(self.path, f) for f in touched]) \
                .filter(~F.coalesce(condition, F.lit(False)))
            new = self._add(rest)
            self._publish([f for f in self.files() if f not in touched] + new)
        return touched

    def vacuum(self) -> int:
        """Delete files that the newest manifest does not name, and older
        manifests; returns how many data files went.  Not while others write."""
        fs, p = _fs(self.spark, self.path)
        live, gone = set(self.files()), 0
        for path in _below(self.spark, os.path.join(self.path, "d*", "*.parquet")):
            if "/".join(path.rsplit("/", 2)[1:]) not in live:
                fs.delete(p(path), False)
                gone += 1
        for _, manifest in self._manifests()[:-1]:
            fs.delete(p(manifest), False)
        return gone
