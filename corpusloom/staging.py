"""Tables staged in the shared folder of the cluster.

A result that is expensive to compute and read more than once is written as a
Parquet table and read back.  This cuts the lineage, survives the loss of any
executor and gives the optimizer true sizes.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Where the setting is absent a private folder is made, but only for a local
    master: on a cluster a machine-local folder would be wrong, so it raises.
    """
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="corpusloom-")
    spark.conf.set(_SETTING, folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one staged table."""
    return f"{shared_dir(spark)}/corpusloom/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once and return the stored table.

    Each call takes a fresh folder unless ``path`` names one to overwrite.
    """
    spark = df.sparkSession
    path = path or new_path(spark, label)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_by(df: DataFrame, label: str, key: str) -> DataFrame:
    """Like :func:`stage`, in buckets of ``key``.

    Joins and groupings on ``key`` then read the table without shuffling it.
    The number of buckets is that of shuffle partitions, so ``df`` is written
    as it lies when it comes out of a join on ``key``.  The table is entered in
    the session catalog under a name of its own.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    name = f"corpusloom_{path.rsplit('/', 1)[1].replace('-', '_')}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.bucketBy(buckets, key).sortBy(key).option("compression", "zstd")
    writer.format("parquet").option("path", path).saveAsTable(name)
    return spark.table(name)
