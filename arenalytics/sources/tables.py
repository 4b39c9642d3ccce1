"""Readers for the driver's parquet tables and for stored layer tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``spark.read.parquet`` of one driver table; columns are pruned and
    filters pushed into the scan by Catalyst."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def write_layer(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite", cluster_by: list[str] | None = None) -> None:
    """Full-refresh table sink (the models' ``materialized: table``).

    ``cluster_by`` (columns readers filter on, then a unique key) range-
    partitions and sorts the rows: each file holds a contiguous slice, so its
    statistics let filters skip it, and a value holding a large share of the
    rows is split over several tasks by the unique key.  ``partition_by``
    stores one folder per value, for few values with many rows each.
    """
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """View sink (``materialized: view``): a lazy, recomputed-per-read name."""
    df.createOrReplaceTempView(name)
    return df
