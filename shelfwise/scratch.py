"""Shared scratch tables: where lineage is cut by writing rows out once."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Folders made for local sessions that name none, by application.
_LOCAL_ROOTS: dict[str, str] = {}
# Spark's setting that drops the shuffle files of a query when it has ended.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session without that setting (tests) gets a temporary folder of its own. On a cluster
    a machine-local folder would lose data with the machine, so a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        app = spark.sparkContext.applicationId
        root = _LOCAL_ROOTS.setdefault(app, "") or tempfile.mkdtemp(prefix="shelfwise-")
        _LOCAL_ROOTS[app] = root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{scratch_root(spark)}/shelfwise/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries ended inside leave no shuffle files behind.

    Otherwise these stay on the executors' disks until the driver happens to collect garbage. For
    writes only: what was written no longer needs its shuffles, whatever executors are lost.
    """
    before = spark.conf.get(_FREE_SHUFFLES, "false")
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder once and read back.

    Later readers see fixed rows in columnar form, whatever executors are lost meanwhile. The
    shuffles behind the rows are freed.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized_for_join(small: DataFrame, name: str, most_rows: int = 100_000) -> DataFrame:
    """A derived table meant as the small side of a join: written, counted, then marked.

    Up to ``most_rows`` narrow rows it is broadcast; beyond that the join is left to Spark, which
    shuffles both sides and splits skewed partitions at run time.
    """
    fixed = written(small, name)
    return F.broadcast(fixed) if fixed.count() <= most_rows else fixed
