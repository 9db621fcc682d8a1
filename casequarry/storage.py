"""Intermediate tables that survive the loss of executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, else the warehouse; executors reach both."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def materialize(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back.

    Cuts the lineage, makes non-deterministic columns stable, and gives the planner the true
    size of the table, so that it broadcasts only what is below its threshold. A filter on
    ``partition_by``, a column of few values, skips the files of the others.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/casequarry/{name}-{uuid.uuid4().hex}"
    writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def spread(scan: DataFrame) -> DataFrame:
    """Deal the rows of a scan with fewer tasks than cores to all cores; else leave it alone.

    A scan of a large table has more tasks than cores and is never shuffled here.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
