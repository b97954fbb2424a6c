"""Feature scaling: parameters are one aggregate row, applied as a scalar subquery."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scale_features(
    df: DataFrame, cols: list[str], method: str = "standard", suffix: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Suffixed scaled columns and the parameter row; zero spread gives 0.0."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    if method not in ("minmax", "standard"):
        raise ValueError("method must be 'minmax' or 'standard'")
    suffix = suffix or f"_{method}"
    params = []
    for c in cols:
        v = F.col(c).cast("double")
        if method == "minmax":
            params += [F.min(v).alias(f"{c}_min"), F.max(v).alias(f"{c}_max")]
        else:
            params += [F.avg(v).alias(f"{c}_mean"), F.stddev_pop(v).alias(f"{c}_std")]
    row = df.agg(*params)
    out = df.withColumn("_p", row.select(F.struct("*")).scalar())
    scaled = {}
    for c in cols:
        v = F.col(c).cast("double")
        if method == "minmax":
            base, spread = F.col(f"_p.{c}_min"), F.col(f"_p.{c}_max") - F.col(f"_p.{c}_min")
        else:
            base, spread = F.col(f"_p.{c}_mean"), F.col(f"_p.{c}_std")
        scaled[c + suffix] = F.when(spread == 0, F.lit(0.0)).otherwise((v - base) / spread)
    return out.withColumns(scaled).drop("_p"), row


def fit_scaler(train: DataFrame, cols: list[str]) -> DataFrame:
    """Mean and population deviation per column over training rows, nulls skipped, zero spread 1."""
    params = []
    for c in cols:
        std = F.stddev_pop(F.col(c).cast("double"))
        params += [F.avg(F.col(c).cast("double")).alias(f"{c}_mean"), F.when(std == 0, 1.0).otherwise(std).alias(f"{c}_std")]
    return train.agg(*params)


def apply_scaler(df: DataFrame, params: DataFrame, cols: list[str]) -> DataFrame:
    """Scale in place; what is still missing afterwards becomes 0."""
    out = df.withColumn("_p", params.select(F.struct("*")).scalar())
    return out.withColumns({
        c: F.coalesce((F.col(c).cast("double") - F.col(f"_p.{c}_mean")) / F.col(f"_p.{c}_std"), F.lit(0.0)) for c in cols
    }).drop("_p")


def inverse_scale(df: DataFrame, params: DataFrame, cols: list[str]) -> DataFrame:
    out = df.withColumn("_p", params.select(F.struct("*")).scalar())
    return out.withColumns({c: F.col(c) * F.col(f"_p.{c}_std") + F.col(f"_p.{c}_mean") for c in cols}).drop("_p")
