"""Reading page and document tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame) -> DataFrame:
    """Share rows over all cores when a source gives too few partitions.

    Compressed archives and files of one row group cannot be split; without
    this all later work would run in one task per file.  A source that already
    fills the cluster is left alone, so nothing is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A Parquet table, pruned to ``columns`` before it is spread."""
    df = spark.read.parquet(path)
    return spread(df.select(*columns) if columns else df)
