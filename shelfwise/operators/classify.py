"""MLlib text classifiers: fit, choose, save, load, score."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.feature import IDF, CountVectorizer, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.labels import label_code, label_decoder
from shelfwise.operators.metrics import best_candidate, cross_entropy
from shelfwise.schema import LABEL, LABELS, TEXT


def text_features(
    text: str = TEXT, features: int = 1 << 16, vocabulary_size: int | None = None, min_documents: int = 2
) -> list:
    """Stages from text to weighted term vectors.

    Hashing needs no pass over the data and its size is fixed; ``vocabulary_size`` asks for a counted
    vocabulary of that size instead.
    """
    split = RegexTokenizer(inputCol=text, outputCol="terms", pattern=r"[^\p{L}\p{N}]+", toLowercase=True)
    if vocabulary_size is None:
        count = HashingTF(inputCol="terms", outputCol="counts", numFeatures=features)
    else:
        count = CountVectorizer(inputCol="terms", outputCol="counts", vocabSize=vocabulary_size, minDF=min_documents)
    return [split, count, IDF(inputCol="counts", outputCol="features", minDocFreq=min_documents)]


def with_code(df: DataFrame, labels: Sequence[str] = LABELS, label: str = LABEL) -> DataFrame:
    return df.withColumn("label", label_code(F.col(label), labels).cast("double"))


def _depth(df: DataFrame) -> int:
    """Levels of a gradient's aggregation tree: one more on large clusters keeps the last step small."""
    return 2 if df.sparkSession.sparkContext.defaultParallelism <= 64 else 3


def _logistic(df: DataFrame, strength: float, iterations: int) -> LogisticRegression:
    return LogisticRegression(
        family="multinomial", regParam=strength, maxIter=iterations, aggregationDepth=_depth(df), tol=1e-5
    )


def loss_of_row(probability: str = "probability", label: str = "label") -> Column:
    return cross_entropy(F.get(vector_to_array(probability), F.col(label).cast("int")))


@dataclass(frozen=True)
class Fitted:
    """The chosen classifier and the validation scores of all candidates."""

    model: PipelineModel
    strength: float
    scores: DataFrame


def fit_text_classifier(
    train: DataFrame,
    val: DataFrame,
    labels: Sequence[str] = LABELS,
    text: str = TEXT,
    label: str = LABEL,
    strengths: Sequence[float] = (0.1, 0.01, 0.001),
    iterations: int = 20,
    **feature_options,
) -> Fitted:
    """Fit one classifier per regularisation strength and keep the one with the least validation loss.

    Term counts are made once and kept, in memory or on disk, for the term weights and all candidates;
    a lost part is computed again from its source. Each fit aggregates gradients as a tree over the
    executors. The driver sees coefficients and one score row per candidate.
    """
    *counting, weighting = text_features(text, **feature_options)
    count = Pipeline(stages=counting).fit(train)
    rows, held = (
        count.transform(with_code(part, labels, label)).select("label", "counts").persist(StorageLevel.MEMORY_AND_DISK)
        for part in (train, val)
    )
    try:
        weight = weighting.fit(rows)
        weighted, weighted_held = weight.transform(rows), weight.transform(held)
        scored, models = [], []
        for number, strength in enumerate(strengths):
            model = _logistic(weighted, strength, iterations).fit(weighted)
            found = model.transform(weighted_held).agg(
                F.avg(loss_of_row()).alias("loss"),
                F.avg(F.when(F.col("prediction") == F.col("label"), 1.0).otherwise(0.0)).alias("accuracy"),
            ).first()
            models.append(model)
            scored.append((number, float(strength), found["loss"], found["accuracy"]))
        scores = train.sparkSession.createDataFrame(
            scored, "candidate int, strength double, loss double, accuracy double"
        )
        chosen = best_candidate(scores).first()
        number = chosen["candidate"] if chosen else 0
    finally:
        rows.unpersist()
        held.unpersist()
    decode = label_decoder(labels, target="predicted")
    model = PipelineModel(stages=[*count.stages, weight, models[number], decode])
    return Fitted(model, strengths[number], scores)


def fit_margin_classifier(
    df: DataFrame,
    features: str = "projected",
    strength: float | None = None,
    iterations: int = 50,
    parallel: int = 1,
) -> Transformer:
    """One linear maximum-margin classifier per label against the rest, on features as they are.

    ``strength`` weighs the penalty against the mean hinge loss; by default it is one over the
    number of rows, which is a support vector machine with unit cost.
    """
    if strength is None:
        strength = 1.0 / max(df.count(), 1)
    one = LinearSVC(
        featuresCol=features, regParam=strength, maxIter=iterations, aggregationDepth=_depth(df), standardization=False
    )
    return OneVsRest(classifier=one, featuresCol=features, labelCol="label", parallelism=parallel).fit(df)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(df: DataFrame, model: PipelineModel, keep: Sequence[str] = ()) -> DataFrame:
    """Predicted label per row; works alike on tables and streams, row by row."""
    return model.transform(df).select(*keep, "predicted")
