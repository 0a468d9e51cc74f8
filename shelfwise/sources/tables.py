"""Parquet tables and small results."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, spread: bool = False
) -> DataFrame:
    """Read Parquet; a given schema spares the footer read of very wide directories.

    A row group is read by one task. ``spread`` hands rows out evenly when the scan has fewer tasks
    than the cluster has cores, for heavy text work on few large row groups; a scan with enough
    tasks stays as it is.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if spread and df.rdd.getNumPartitions() < cores else df


def write_table(df: DataFrame, path: str, partition_by: str | None = None, rows_per_file: int | None = None) -> None:
    """Replace the table at ``path``.

    ``partition_by`` lets later filters on that column prune whole folders. Rows are written by
    the tasks that hold them, so a label with most of the rows is still written by many tasks.
    """
    writer = df.write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def fetch_small(df: DataFrame, most: int = 10_000) -> pd.DataFrame:
    """The whole result as pandas; more than ``most`` rows is an error, never a silent cut."""
    rows = df.limit(most + 1).toPandas()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows: write a table instead of fetching")
    return rows
