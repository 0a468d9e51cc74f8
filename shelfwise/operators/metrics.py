"""Classification metrics from a table of actual and predicted labels.

Every score comes from the counts per label pair: one pass with partial aggregation, after which at
most labels x labels rows are left, whatever the share of the largest label.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.functions.arrays import percent, ratio
from shelfwise.scratch import written


def pair_counts(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def label_scores(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """``label, precision, recall, f1, support`` for every label that is actual or predicted.

    A score without a base is 0.
    """
    pairs = pair_counts(df, actual, predicted)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    none = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("support"), none.alias("named"), hit.alias("hits")),
        F.struct(F.col("predicted").alias("label"), none.alias("support"), F.col("n").alias("named"), none.alias("hits")),
    )
    totals = (
        pairs.select(F.inline(sides))
        .groupBy("label")
        .agg(F.sum("support").alias("support"), F.sum("named").alias("named"), F.sum("hits").alias("hits"))
    )
    precision, recall = ratio(F.col("hits"), F.col("named")), ratio(F.col("hits"), F.col("support"))
    return totals.select(
        "label",
        precision.alias("precision"),
        recall.alias("recall"),
        ratio(2 * F.col("hits"), F.col("named") + F.col("support")).alias("f1"),
        "support",
        "hits",
    )


def _weighted(score: str) -> Column:
    return ratio(F.sum(F.col(score) * F.col("support")), F.sum("support"))


def summary(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """One row: accuracy and support-weighted precision, recall and F1."""
    return label_scores(df, actual, predicted).agg(
        ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        _weighted("f1").alias("f1"),
        _weighted("precision").alias("precision"),
        _weighted("recall").alias("recall"),
    )


def accuracy(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    return df.agg(F.avg(F.when(F.col(actual) == F.col(predicted), 1.0).otherwise(0.0)).alias("accuracy"))


def report(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Scores per label plus the rows ``accuracy``, ``macro avg`` and ``weighted avg``."""
    scores = label_scores(df, actual, predicted)
    total = F.sum("support")
    right = ratio(F.sum("hits"), total)
    names = ("precision", "recall", "f1")

    def row(name: str, values: Sequence[Column]) -> Column:
        return F.struct(
            F.lit(name).alias("label"),
            *[v.alias(n) for n, v in zip(names, values)],
            total.alias("support"),
        )

    lines = F.array(
        row("accuracy", [right] * 3),
        row("macro avg", [F.avg(n) for n in names]),
        row("weighted avg", [_weighted(n) for n in names]),
    )
    overall = scores.agg(lines.alias("lines")).select(F.inline("lines"))
    each = scores.select(F.col("label").cast("string"), *names, "support")
    return each.unionByName(overall)


def confusion(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted", labels: Sequence | None = None
) -> DataFrame:
    """``actual, predicted, n, share, percent`` for every pair of labels; shares are per actual label.

    Without ``labels`` every label that occurs is used, as in a matrix of seen labels. An actual
    label without rows has shares of 0.
    """
    pairs = pair_counts(df, actual, predicted)
    if labels is not None:
        known = df.sparkSession.range(1).select(F.array(*[F.lit(v) for v in labels]).alias("labels"))
    else:
        # One value per label, gathered after the pair count: as small as the label domain.
        known = pairs.select(F.explode(F.array("actual", "predicted")).alias("label")).agg(
            F.collect_set("label").alias("labels")
        )
    grid = known.select("labels", F.explode("labels").alias("__actual")).select(
        "__actual", F.explode("labels").alias("__predicted")
    )
    same = (F.col("actual") == F.col("__actual")) & (F.col("predicted") == F.col("__predicted"))
    row = W.partitionBy("actual")
    return (
        grid.join(pairs, same, "left")
        .select(
            F.col("__actual").alias("actual"),
            F.col("__predicted").alias("predicted"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
        .withColumn("share", ratio(F.col("n"), F.sum("n").over(row)))
        .withColumn("percent", percent(F.col("share")))
    )


def batch_scores(
    df: DataFrame, batch: str = "batch", actual: str = "actual", predicted: str = "predicted", loss: str | None = None
) -> DataFrame:
    """Mean accuracy per mini-batch, and mean loss if there is a loss column."""
    right = F.when(F.col(actual) == F.col(predicted), 1.0).otherwise(0.0)
    means = [F.avg(right).alias("accuracy")]
    if loss is not None:
        means.append(F.avg(loss).alias("loss"))
    return df.groupBy(batch).agg(*means)


def mean_of_batches(scores: DataFrame, *names: str) -> DataFrame:
    """Plain mean over mini-batches; a short last batch weighs as much as a full one."""
    return scores.agg(F.count(F.lit(1)).alias("batches"), *[F.avg(n).alias(n) for n in names])


def running_means(
    scores: DataFrame, *names: str, index: str = "batch", every: int = 100, blocks_per_chunk: int = 10_000
) -> DataFrame:
    """Mean of each column over all batches so far, for every ``every``-th batch and the last one.

    Batches are first summed per reporting block (on the map side), blocks are summed up inside
    chunks in parallel, and a chunk starts from the total of the chunks before it. Only chunk totals,
    one per ``every * blocks_per_chunk`` batches, meet in one task. The block sums are written once,
    since both the chunks and their starts are made from them.
    """
    block = F.floor(F.col(index) / every)
    sums = [F.sum(n).alias(f"__{n}") for n in names]
    blocks = scores.groupBy(block.alias("__block")).agg(
        F.max(index).alias("step"), F.count(F.lit(1)).alias("__rows"), *sums
    )
    blocks = written(blocks.withColumn("__chunk", F.floor(F.col("__block") / blocks_per_chunk)), "step-sums")
    parts = ["__rows", *[f"__{n}" for n in names]]
    upto = W.partitionBy("__chunk").orderBy("__block").rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1)
    chunks = (
        blocks.groupBy("__chunk")
        .agg(*[F.sum(p).alias(p) for p in parts])
        .select("__chunk", *[F.coalesce(F.sum(p).over(before), F.lit(0)).alias(f"{p}_before") for p in parts])
    )
    summed = blocks.select("__chunk", "step", *[F.sum(p).over(upto).alias(p) for p in parts]).join(chunks, "__chunk")
    rows = F.col("__rows") + F.col("__rows_before")
    return summed.select("step", *[((F.col(f"__{n}") + F.col(f"__{n}_before")) / rows).alias(n) for n in names])


def cross_entropy(probability: Column) -> Column:
    """Loss of one row from the probability given to its actual label; null if there is none."""
    return F.when(probability.isNotNull(), -F.log(F.greatest(probability, F.lit(1e-15))))


def softmax_at(scores: Column, position: Column) -> Column:
    """Probability of one position of a score array."""
    top = F.array_max(scores)
    weights = F.transform(scores, lambda s: F.exp(s.cast("double") - top.cast("double")))
    total = F.aggregate(weights, F.lit(0.0).cast("double"), lambda a, w: a + w)
    return F.get(weights, position) / total


def best_candidate(scores: DataFrame, loss: str = "loss", candidate: str = "candidate") -> DataFrame:
    """The candidate with the strictly smallest loss; the earliest one wins a tie."""
    return scores.filter(F.col(loss).isNotNull() & ~F.isnan(loss)).orderBy(loss, candidate).limit(1)
