"""Raw JSON lines to a Parquet table of model input, malformed lines to a table of their own if wanted."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.project import keep_columns
from shelfwise.operators.sampling import sample_share
from shelfwise.plans.preprocess import preprocess
from shelfwise.schema import KEPT, KEY
from shelfwise.scratch import scratch_path
from shelfwise.sources.json_lines import MALFORMED, read_json_lines
from shelfwise.sources.tables import write_table


@dataclass(frozen=True)
class Loaded:
    """Lines read, and those of them that were malformed."""

    lines: int
    malformed: int


def routed_lines(
    spark: SparkSession, source: str | list[str], partitions: int | None = None
) -> tuple[DataFrame, DataFrame, int, int]:
    """Good rows, malformed lines, and how many lines there were in all and of the latter.

    Malformed is what is no JSON or has a wanted field of another type; other fields are not read.

    One scan: rows are dealt out evenly as they come, since a gzip file is read by one task, and are
    stored in two folders, which later reads tell apart without looking at the other. The counters
    are observed while the rows pass.
    """
    raw = read_json_lines(spark, source, keep_malformed=True)
    kept = [c for c in KEPT if c in raw.columns]
    counted = Observation()
    broken = F.col(MALFORMED).isNotNull()
    spread = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (
        keep_columns(raw, [*kept, MALFORMED])
        .withColumn("malformed_line", broken)
        .observe(counted, F.count(F.lit(1)).alias("lines"), F.coalesce(F.sum(broken.cast("bigint")), F.lit(0)).alias("malformed"))
        .repartition(spread)
    )
    path = scratch_path(spark, "lines")
    rows.write.partitionBy("malformed_line").parquet(path)
    found = counted.get
    schema = rows.drop("malformed_line").schema.add("malformed_line", "boolean")
    stored = spark.read.schema(schema).parquet(path)
    good = stored.filter(~F.col("malformed_line")).select(*kept)
    return good, stored.filter("malformed_line").select(MALFORMED), found["lines"], found["malformed"]


def run_etl(
    spark: SparkSession,
    source: str | list[str],
    target: str,
    vocabulary: DataFrame | None = None,
    fraction: float = 1.0,
    seed: int = 42,
    style: str = "flat",
    mode: str = "PERMISSIVE",
    partitions: int | None = None,
    rejected: str | None = None,
    **options,
) -> Loaded | None:
    """Extract, sample, transform and load. The sample is taken before any text work.

    With ``rejected``, malformed lines are stored there, all of them, as text, and never become rows of
    the target; their number is given back. Without it they are what the reader's ``mode`` makes of
    them: rows of nulls, hence empty texts (PERMISSIVE), nothing (DROPMALFORMED), or an error (FAILFAST).
    """
    if rejected is None:
        raw = read_json_lines(spark, source, mode=mode, partitions=partitions)
        write_table(preprocess(sample_share(raw, fraction, KEY, seed), style, vocabulary, **options), target)
        return None
    if mode != "PERMISSIVE":
        raise ValueError(f"mode {mode} leaves no malformed lines to store")
    good, broken, lines, malformed = routed_lines(spark, source, partitions)
    write_table(preprocess(sample_share(good, fraction, KEY, seed), style, vocabulary, **options), target)
    write_table(broken, rejected)
    return Loaded(lines, malformed)
