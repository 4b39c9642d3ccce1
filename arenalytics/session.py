"""Spark session and shared-folder helpers.

The library never assumes a machine-local scratch folder.  Everything that has
to be written between stages (checkpoints, landing folders of the incremental
load, sinks built by a query) lives under ``spark.checkpoint.dir``, the shared
folder the cluster names.  Only when that setting is missing (unit tests, a
laptop) do we pick a folder of our own.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Settings the models need on any session they run in (runtime SQL confs, so
# they can be applied to a session the caller built).
#  * UTC: epoch → timestamp/date conversions of the staging layer.
#  * hugeMethodLimit 8000: HotSpot does not JIT-compile methods above 8000
#    bytes of bytecode; a whole-stage-codegen stage whose method is larger
#    would run interpreted (4× slower on the staging projection).  Above the
#    limit Spark splits the stage into per-operator compiled code instead.
#  * variant.allowDuplicateKeys: the last of two equal keys counts.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def apply_runtime_conf(spark: SparkSession) -> None:
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)


@contextmanager
def runtime_settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Settings for the jobs run inside; the session's own come back after them."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def build_session(master: str | None = None, app: str = "arenalytics",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the library relies on.

    ``timeZone=UTC`` pins epoch → timestamp/date conversions; ANSI stays on so
    a division by zero is an error unless guarded (the models guard with
    ``nullif``).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    conf.update(RUNTIME_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, total_cores: int,
                 partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Sizing for a cluster run over ``input_bytes`` of raw Parquet.

    Shuffle partitions scale with the data (≈ ``partition_bytes`` of shuffle
    input each, never fewer than two waves of tasks) so a reducer's share fits
    executor memory without spilling; AQE then coalesces small partitions and
    splits skewed ones at run time.  Scan splits match the shuffle target.
    The broadcast threshold stays Spark's size-checked default.
    """
    partitions = max(2 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only if none is set.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is.  Only a local master may leave it unset; then a fresh folder under
    the system temp directory is registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and "
                               "all executors share")
        conf_dir = tempfile.mkdtemp(prefix="arenalytics-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_SCOPE: ContextVar[str | None] = ContextVar("scratch_scope", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never reused folder below the shared checkpoint folder (inside
    ``scratch_scope``, below the scope's folder)."""
    base = _SCOPE.get() or ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the library's own (the cluster's Hadoop client)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch_scope(spark: SparkSession, name: str) -> Iterator[str]:
    """What is materialized inside goes when the scope ends, also by an error:
    for steps whose results are written elsewhere by then."""
    path = scratch_path(spark, name)
    token = _SCOPE.set(path)
    try:
        yield path
    finally:
        _SCOPE.reset(token)
        remove_folder(spark, path)


def materialize(df, name: str, compression: str = "snappy"):
    """Cut lineage by writing ``df`` as Parquet to a new folder below the
    shared checkpoint folder and reading it back.

    Preferred over ``DataFrame.checkpoint`` for wide intermediate tables:
    columnar and compressed on disk, and every later reader scans only the
    columns it uses.  Losing an executor after this point re-reads the files
    instead of recomputing the lineage.  Tables that hold texts are written
    with ``zstd``.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return df.sparkSession.read.parquet(path)
