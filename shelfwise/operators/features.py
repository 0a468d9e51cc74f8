"""Feature vectors: scaling and truncated singular value decomposition."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The matrix of column products is held by the driver: 4,096 columns are 128 MB.
MOST_COLUMNS = 4_096


def id_features(items: Column) -> Column:
    """A dense vector from an array of numbers, such as token ids."""
    return array_to_vector(items.cast("array<double>"))


def fit_scale(df: DataFrame, features: str = "features", target: str = "scaled") -> ElementwiseProduct:
    """Divide each column by its population deviation, without centring; constant columns stay.

    One pass of tree aggregation; the result is an ordinary MLlib transformer.
    """
    found = df.select(
        Summarizer.metrics("variance", "count").summary(F.col(features)).alias("s")
    ).select("s.variance", "s.count").first()
    n = found["count"]
    if not n:
        raise ValueError("no rows to scale")
    deviation = np.sqrt(found["variance"].toArray() * (max(n - 1, 0) / n))
    factors = np.where(deviation > 0, 1.0 / np.where(deviation > 0, deviation, 1.0), 1.0)
    return ElementwiseProduct(scalingVec=Vectors.dense(factors), inputCol=features, outputCol=target)


@dataclass(frozen=True)
class Projection:
    """The first right singular vectors, one per column of ``axes``."""

    axes: np.ndarray
    values: np.ndarray

    def transform(self, df: DataFrame, features: str = "scaled", target: str = "projected") -> DataFrame:
        axes = self.axes

        @F.pandas_udf("array<double>")
        def project(rows: pd.Series) -> pd.Series:
            if rows.empty:
                return pd.Series([], dtype=object)
            return pd.Series(list(np.stack(rows.to_numpy()) @ axes))

        return df.withColumn(target, array_to_vector(project(vector_to_array(features))))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, float(v), self.axes[:, i].tolist()) for i, v in enumerate(self.values)]
        spark.createDataFrame(rows, "component int, value double, axis array<double>").write.mode(
            "overwrite"
        ).parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Projection:
        rows = spark.read.parquet(path).orderBy("component").collect()
        return Projection(np.array([r["axis"] for r in rows]).T, np.array([r["value"] for r in rows]))


def fit_projection(df: DataFrame, k: int, features: str = "scaled") -> Projection:
    """Truncated SVD without centring.

    The columns are few and fixed (the encoded length), the rows many: one tree aggregation makes the
    matrix of column products, whose eigenvectors are the right singular vectors. Signs are fixed by
    making the largest entry of each axis positive.
    """
    width = len(df.select(features).first()[0])
    if width > MOST_COLUMNS:
        raise ValueError(f"{width} columns: encode to at most {MOST_COLUMNS} first")
    vectors = MLUtils.convertVectorColumnsFromML(df.select(features), features)
    products = RowMatrix(vectors, numCols=width).computeGramianMatrix().toArray()
    values, axes = np.linalg.eigh(products)
    order = np.argsort(values)[::-1][:k]
    axes = axes[:, order]
    axes = axes * np.sign(axes[np.argmax(np.abs(axes), axis=0), np.arange(axes.shape[1])])
    return Projection(axes, np.sqrt(np.clip(values[order], 0.0, None)))
