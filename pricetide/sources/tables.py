"""Readers for the driver's parquet tables (S3: table scan)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


_SCANS: dict = {}


def read_table(spark: SparkSession, sf_dir: str, name: str, refresh: bool = False) -> DataFrame:
    """Parquet scan; projections and filters applied later reach the scan
    (ReadSchema / PushedFilters) through Catalyst.

    The scan *definition* (file listing and footer schema) is reused per
    session: the given tables are read-only, and every query still plans and
    reads its own data.  ``refresh=True`` lists the files again."""
    key = (id(spark), spark.sparkContext.applicationId, table_path(sf_dir, name))
    if refresh or key not in _SCANS:
        _SCANS[key] = spark.read.parquet(table_path(sf_dir, name))
    return _SCANS[key]


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Round-robin repartition to a stated number, for CPU-heavy per-row work on few
    splits (e.g. a file written as one row group).  The number is an argument or the
    session's ``pricetide.scan.partitions``; without either the scan is left as it is."""
    stated = partitions or df.sparkSession.conf.get("pricetide.scan.partitions", None)
    return df.repartition(int(stated)) if stated else df


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES, prefix: str = "") -> None:
    """Expose the driver tables as temp views for ``spark.sql``."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(prefix + n)
