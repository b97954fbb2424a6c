"""Scoring of feature sequences and forecast tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from emberfield.functions import fire


def score_table(df: DataFrame, scorer: Callable, sequence: str, output: str = "fire_probability") -> DataFrame:
    """Apply a caller's model to batches.

    ``scorer`` maps a numpy block (rows, steps, features) to probabilities (rows,
    horizons); all sequences have the same steps and features (see ``sequence_shape_contract``).
    """
    schema = StructType([*df.schema.fields, StructField(output, ArrayType(DoubleType()))])
    at = df.columns.index(sequence)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column(at)
            steps = column.flatten()
            shape = (b.num_rows, len(steps) // max(1, b.num_rows), -1 if len(steps) else 0)
            scores = np.asarray(scorer(steps.flatten().to_numpy(zero_copy_only=False).reshape(shape)), float) if b.num_rows else np.empty((0, 0))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(scores), pa.list_(pa.float64()))], [*b.schema.names, output])

    return df.mapInArrow(run, schema)


def risk_table(df: DataFrame, probabilities: str = "fire_probability", threshold: float = 0.5) -> DataFrame:
    """Probabilities with levels, labels, factors, mean score and burning flags."""
    return df.withColumn("_v", fire.risk_vectors(F.col(probabilities), threshold)).select("*", "_v.*").drop("_v")


def train_baseline(train: DataFrame, features: list[str], label: str, pos_weight: float):
    """Class-weighted logistic regression (Spark ML) on the rows of ``train`` that have all features."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    known = train.dropna(subset=[*features, label])
    weighted = known.withColumn("_w", F.when(F.col(label) == 1, F.lit(float(pos_weight))).otherwise(F.lit(1.0)))
    stages = [
        VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="keep"),
        LogisticRegression(featuresCol="_x", labelCol=label, weightCol="_w", maxIter=20),
    ]
    return Pipeline(stages=stages).fit(weighted)


def apply_baseline(model, df: DataFrame, output: str = "p") -> DataFrame:
    """Every row with its probability; NULL where a feature is missing."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(df).withColumn("_p", vector_to_array("probability")[1])
    return scored.withColumn(output, F.when(~F.isnan("_p"), F.col("_p"))).drop("_p", "_x", "rawPrediction", "probability", "prediction")
