"""JSON-lines records, plain or gzipped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.schema import PRODUCT

MALFORMED = "malformed"


def read_json_lines(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = PRODUCT,
    mode: str = "PERMISSIVE",
    keep_malformed: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Read one JSON object per line under an explicit schema, so that no inference pass runs.

    ``mode`` is Spark's policy for broken lines: PERMISSIVE keeps them as rows of nulls,
    DROPMALFORMED skips them, FAILFAST fails the job. ``keep_malformed`` adds their text in
    a column. A gzip file is one task whatever its size: ship many files, or pass ``partitions``
    to spread the rows of a few large ones before the heavy work.
    """
    reader = spark.read.option("mode", mode)
    if keep_malformed:
        schema = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED)
    df = reader.schema(schema).json(path)
    return df.repartition(partitions) if partitions else df


def write_json_lines(df: DataFrame, path: str, compression: str = "gzip") -> None:
    df.write.mode("overwrite").option("compression", compression).json(path)


def json_fields(text: Column, schema: T.StructType | str) -> Column:
    """A struct parsed from JSON held in a column; text that is no JSON gives null fields."""
    return F.from_json(text, schema)
