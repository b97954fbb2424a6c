"""Train/validation/test splits, sampling and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberfield.functions import time
from emberfield.operators.ordering import first_rows, number_rows
from emberfield.session import sized_broadcast

# Validation starts, training period ends, test starts.
SPLIT_DATES = ("2021-01-01", "2021-06-30", "2021-07-01")


def time_split_dates(ts: Column, dates: tuple[str, str, str] = SPLIT_DATES, close_gap: bool = False) -> Column:
    """Split name by date; rows between the end of validation and the start of test have none.

    The validation end is midnight, so noon of that day is in no split unless ``close_gap``.
    """
    start_val, end_val, start_test = (F.lit(d).cast(time.NTZ) for d in dates)
    in_val = (ts < start_test) if close_gap else (ts <= end_val)
    return F.when(ts < start_val, "train").when(in_val, "val").when(ts >= start_test, "test")


def time_split_ratio(df: DataFrame, ts: str, train_val: float = 0.9, train: float = 0.85) -> DataFrame:
    """Split by the rank of each distinct time, keeping temporal order."""
    axis = number_rows(df.select(ts).distinct(), [ts], "t_idx", start=0)
    total = axis.agg(F.count(F.lit(1))).scalar()
    named = axis.withColumn("_n", total).withColumn("_tv", F.floor(F.col("_n") * F.lit(train_val)))
    named = named.withColumn("_tr", F.floor(F.col("_tv") * F.lit(train)))
    split = F.when(F.col("t_idx") < F.col("_tr"), "train").when(F.col("t_idx") < F.col("_tv"), "val").otherwise("test")
    return df.join(sized_broadcast(named.select(ts, "t_idx", split.alias("split"))), ts)


def sequence_split_ratio(samples: DataFrame, order: list[str], train_val: float = 0.9, train: float = 0.85) -> DataFrame:
    """The same ratios applied to samples after windowing."""
    ranked = number_rows(samples, order, "_i", start=0)
    total = samples.agg(F.count(F.lit(1))).scalar()
    out = ranked.withColumn("_n", total).withColumn("_tv", F.floor(F.col("_n") * F.lit(train_val)))
    split = F.when(F.col("_i") < F.floor(F.col("_tv") * F.lit(train)), "train").when(
        F.col("_i") < F.col("_tv"), "val"
    ).otherwise("test")
    return out.withColumn("split", split).drop("_i", "_n", "_tv")


_INTEGERS = ("byte", "short", "integer", "long")


def _leads_with_integer(df: DataFrame, order: list[Column]) -> bool:
    return df.select(order[0].alias("o")).schema["o"].dataType.typeName() in _INTEGERS


def negative_subsample(
    df: DataFrame, label: str, key: list[str], ratio: int = 20, seed: int = 42, order: list[Column] | None = None, by: str | None = None
) -> DataFrame:
    """All positives and exactly ``ratio`` negatives per positive, the first by ``order``, else by hashed key.

    The last negative taken is found by counting ranges of the order; the negatives are not sorted. ``by`` names a column of few
    values (e.g. the split), each with a sample of its own.
    """
    positives, negatives = df.where(F.col(label) == 1), df.where(F.col(label) == 0)
    order = order or [F.xxhash64(F.lit(seed), *key)]
    if _leads_with_integer(df, order):
        if by:
            wanted = {g: n * ratio for g, n in positives.groupBy(by).count().collect()}
            return positives.unionByName(first_rows(negatives, order, key, wanted, by)[0])
        return positives.unionByName(first_rows(negatives, order, key, {0: positives.count() * ratio})[0])
    group = F.col(by) if by else F.lit(0)
    ranked = number_rows(negatives.withColumns({"_g": group, "_h": F.struct(*order)}), ["_g", "_h", *key], "_i")
    starts = ranked.groupBy("_g").agg(F.min("_i").alias("_s")).withColumnRenamed("_g", "_l")
    wanted = positives.groupBy(group.alias("_w")).agg((F.count(F.lit(1)) * ratio).alias("_n"))
    limits = sized_broadcast(starts.join(wanted, F.col("_l").eqNullSafe(F.col("_w"))))
    kept = ranked.join(limits, F.col("_g").eqNullSafe(F.col("_l"))).where(F.col("_i") - F.col("_s") < F.col("_n"))
    return positives.unionByName(kept.select(*df.columns))


def stratified_split(
    df: DataFrame, label: str, key: list[str], fraction: float = 0.1, seed: int = 42, order: list[Column] | None = None
) -> DataFrame:
    """Validation share per label by hashed key: the first floor(fraction x rows) of each label.

    Labels are few and each may hold most of the table: the border of each is found by counting ranges of
    the order, all labels at once, and only the rows at a border are numbered.
    """
    rank = order or [F.xxhash64(F.lit(seed), *key)]
    groups = df.groupBy(label).agg(F.floor(F.count(F.lit(1)) * F.lit(fraction)).alias("n")).collect()
    if _leads_with_integer(df, rank):
        val, train = first_rows(df, rank, key, {r[0]: r["n"] for r in groups}, label)
        return val.withColumn("split", F.lit("val")).unionByName(train.withColumn("split", F.lit("train")))
    named = df.withColumns({f"_h{i}": c for i, c in enumerate(rank)})
    ranked = number_rows(named, [label, *[f"_h{i}" for i in range(len(rank))], *key], "_i", start=0)
    starts = ranked.groupBy(label).agg(F.min("_i").alias("_s"), F.floor(F.count(F.lit(1)) * F.lit(fraction)).alias("_n"))
    sized = ranked.join(sized_broadcast(starts.withColumnRenamed(label, "_l")), F.col(label).eqNullSafe(F.col("_l")))
    return sized.withColumn("split", F.when(F.col("_i") - F.col("_s") < F.col("_n"), "val").otherwise("train")).select(*df.columns, "split")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Positive weight, alpha and rate over the given (training, valid) cells."""
    pos = F.count_if(F.col(label) == 1)
    total = F.count(F.lit(1))
    weight = F.when(pos == 0, F.lit(1.0)).otherwise((total - pos) / pos)
    return df.agg(
        weight.alias("pos_weight"), pos.alias("positives"), (total - pos).alias("negatives"),
        F.when(pos == 0, F.lit(0.0)).otherwise(pos / total).alias("positive_rate"),
        (weight / (weight + 1)).alias("alpha"),
    )
