"""Bucketed, sorted tables in the shared folder, found again by their path."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.scratch import shuffles_freed


def buckets_of(spark: SparkSession) -> int:
    """Buckets of a new table: the session's shuffle width, so a join moves one side only."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_rows(spark: SparkSession, path: str, schema: str) -> list:
    """The rows of a small table of settings; none if nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def settled_buckets(spark: SparkSession, path: str, wanted: int | None) -> int:
    """The bucket count kept beside the tables under ``path``; set by whoever opens it first.

    Files of another bucket count would be joined wrongly, so one that differs is refused.
    """
    kept = small_rows(spark, f"{path}-layout", "buckets INT")
    if not kept:
        count = wanted or buckets_of(spark)
        spark.range(1).select(F.lit(count).alias("buckets")).write.mode("overwrite").parquet(f"{path}-layout")
        return count
    if wanted and wanted != kept[0]["buckets"]:
        raise ValueError(f"{path} has {kept[0]['buckets']} buckets, not {wanted}")
    return kept[0]["buckets"]


def table_at(path: str) -> str:
    """The catalog name of the table at ``path``."""
    return "stored_" + hashlib.md5(path.encode()).hexdigest()


def attach(spark: SparkSession, path: str, columns: str, key: str, buckets: int) -> str:
    """Name the table at ``path`` in this session's catalog, new or kept from earlier sessions."""
    name = table_at(path)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return name


def append(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """Add rows to the table: one sorted file for each bucket."""
    writer = df.repartition(buckets, key).write.mode("append").format("parquet").bucketBy(buckets, key).sortBy(key)
    with shuffles_freed(df.sparkSession):
        writer.saveAsTable(name)
    df.sparkSession.catalog.refreshTable(name)
