"""Scoring requests as they arrive as files.

Every step works on single rows: there is no state, hence no watermark and no late data.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfwise.plans.predict import answer, predict
from shelfwise.schema import REQUEST


def request_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = REQUEST,
    file_format: str = "json",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Requests from a folder; ``files_per_batch`` bounds the work of one micro-batch."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(file_format).load(path)


def start_scoring(
    requests: DataFrame,
    model: PipelineModel,
    output: str,
    checkpoint: str,
    once: bool = True,
    include_key: bool = True,
) -> StreamingQuery:
    """Write predictions for accepted requests to Parquet, each request exactly once.

    ``include_key`` must be as in the preparation of the training texts.
    """
    return start_writing(predict(requests, model, include_key), output, checkpoint, once)


def start_writing(rows: DataFrame, output: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append rows to Parquet. ``once`` takes what is there now and stops; else the query keeps running."""
    writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(output)


def write_answers(
    batch: DataFrame, number: int, model: PipelineModel, output: str, refused: str, include_key: bool = True
) -> None:
    """Write one micro-batch to both tables, each under the number of the batch.

    A batch that is run again, after a failure between the two writes or after both, replaces what
    it wrote before, so both tables hold every request once.
    """
    for rows, path in zip(answer(batch, model, include_key), (output, refused)):
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")


def start_answering(
    requests: DataFrame,
    model: PipelineModel,
    output: str,
    refused: str,
    checkpoint: str,
    once: bool = True,
    include_key: bool = True,
) -> StreamingQuery:
    """Write predictions of accepted requests to ``output`` and rejected requests with reasons to ``refused``.

    Both are Parquet tables with a column ``batch``. ``once`` takes what is there now and stops.
    """

    def each(batch: DataFrame, number: int) -> None:
        write_answers(batch, number, model, output, refused, include_key)

    writer = requests.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
