"""Total orders without a single-task window.

Rows are range-partitioned on the full order key, so even one key holding a
third of the table is split over many tasks, then written once to reliable
storage: both the rows and the per-partition totals are read from that copy and
therefore agree on the boundaries, and the totals read only their own columns. The
number of ranges follows the size of the input files. Only the per-partition totals
(one row per range) are ever broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emberfield.session import data_partitions, durable

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def _columns(order: list) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _ranged(df: DataFrame, order: list) -> DataFrame:
    cols = _columns(order)
    return durable(
        df.repartitionByRange(data_partitions(df), *cols)
        .sortWithinPartitions(*cols)
        .withColumn("_slot", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_slot", _ROW_BITS))
    )


def number_rows(df: DataFrame, order: list, id_col: str = "row_id", start: int = 1) -> DataFrame:
    """Consecutive BIGINT ids in ``order``; ``order`` must identify a row to be deterministic."""
    ranged = _ranged(df, order)
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"))
    )
    low = F.col("_slot") - F.shiftleft("_part", _ROW_BITS)
    return (
        ranged.join(F.broadcast(offsets), "_part")
        .withColumn(id_col, F.col("_offset") + low + F.lit(start))
        .drop("_part", "_slot", "_offset")
    )


def running_sums(df: DataFrame, order: list, sums: dict[str, str]) -> DataFrame:
    """Running totals in ``order``: ``sums`` maps an output column to the summed column."""
    ranged = _ranged(df, order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_part").agg(*[F.sum(c).alias(f"_t_{o}") for o, c in sums.items()])
    offsets = totals.select(
        "_part", *[F.coalesce(F.sum(f"_t_{o}").over(before), F.lit(0)).alias(f"_o_{o}") for o in sums]
    )
    inside = Window.partitionBy("_part").orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select(
        "*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_l_{o}") for o, c in sums.items()]
    )
    out = local.join(F.broadcast(offsets), "_part")
    for o in sums:
        out = out.withColumn(o, F.col(f"_l_{o}") + F.col(f"_o_{o}"))
    return out.select(*df.columns, *sums)


def previous_row(df: DataFrame, order: list, cols: dict[str, str], step: int = 1) -> DataFrame:
    """Global ``lag``: ``cols`` maps an output column to the column taken ``step`` rows earlier."""
    ids = number_rows(df, order, "_row")
    shifted = ids.select((F.col("_row") + step).alias("_row"), *[F.col(c).alias(o) for o, c in cols.items()])
    return ids.join(shifted, "_row", "left").drop("_row")


def exact_quantiles(df: DataFrame, col: str, probabilities: list[float]) -> DataFrame:
    """Linear-interpolated quantiles of the non-null values, one row per probability.

    Works on per-value counts, so a frequent value is one row, and no task holds
    all distinct values.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("v")).agg(
        F.count(F.lit(1)).alias("n")
    )
    cum = running_sums(counts, ["v"], {"upto": "n"})
    total = counts.agg(F.sum("n").alias("t")).scalar()
    targets = F.array(*[
        F.struct(F.lit(float(p)).alias("probability"), ((F.col("_t") - 1) * F.lit(float(p))).alias("h"))
        for p in probabilities
    ])
    lo, hi = F.col("upto") - F.col("n"), F.col("upto")

    hits = (
        cum.withColumn("_t", total)
        .select("v", lo.alias("lo"), hi.alias("hi"), F.explode(targets).alias("p"))
        .select("v", "lo", "hi", "p.probability", "p.h")
        .where(
            ((F.floor("h") >= F.col("lo")) & (F.floor("h") < F.col("hi")))
            | ((F.ceil("h") >= F.col("lo")) & (F.ceil("h") < F.col("hi")))
        )
    )
    # at most two values survive per probability: the neighbours of the wanted position
    low, high = F.min("v"), F.max("v")
    return hits.groupBy("probability", "h").agg(low.alias("low"), high.alias("high")).select(
        "probability",
        (F.col("low") + (F.col("high") - F.col("low")) * (F.col("h") - F.floor("h"))).alias("quantile"),
    )


def first_rows(df: DataFrame, order: list[Column], ties: list[str], wanted: dict, group: str | None = None, sorted_rows: int = 20_000) -> tuple[DataFrame, DataFrame]:
    """``df`` in two parts: the first ``wanted[g]`` rows of each group in ``order``, and the others.

    The place of the last wanted row is found by counting, not sorting: the leading order column, an integer, is counted in up
    to 1024 ranges, the range that holds the place is counted again in finer ones, until few rows or one value
    are left. Only the rows of that last range are numbered, by all of ``order`` and ``ties``. All groups go through the
    rounds together; at most 1024 counts a group reach the driver, so groups must be few. Null keys come first.
    """
    least = -(1 << 63)
    of = F.col(group) if group else F.lit(0)
    named = df.withColumns({"_g": of, **{f"_o{i}": c for i, c in enumerate(order)}})
    key = F.coalesce(F.col("_o0").cast("bigint"), F.lit(least))
    keys = named.select("_g", key.alias("_key"))
    state = {}  # group -> (lowest key, bits left, rows still wanted); ranges are lowest .. lowest + 2**bits - 1
    for g, low, high, n in keys.groupBy("_g").agg(F.min("_key"), F.max("_key"), F.count(F.lit(1))).collect():
        bits = 64 if low < 0 <= high else (low ^ high).bit_length()
        state[g] = [low >> bits << bits if bits < 64 else least, bits, min(wanted.get(g, 0), n), n]

    def in_range(g, value: Column) -> Column:
        low, bits, _, _ = state[g]
        return F.col("_g").eqNullSafe(F.lit(g)) & value.between(low, min(low + (1 << bits), 1 << 63) - 1)

    def any_of(conditions: list[Column]) -> Column:
        out = F.lit(False)
        for c in conditions:
            out = out | c
        return out

    while open_ := [g for g, (_, bits, k, n) in state.items() if 0 < k < n and bits and n > sorted_rows]:
        step = F.lit(None)
        for g in open_:
            step = F.when(F.col("_g").eqNullSafe(F.lit(g)), F.shiftright("_key", max(0, state[g][1] - 10))).otherwise(step)
        counted = keys.where(any_of([in_range(g, F.col("_key")) for g in open_])).groupBy("_g", step.alias("_bin")).count().collect()
        for g in open_:
            finer = max(0, state[g][1] - 10)
            for bin_, n in sorted((b, n) for of_g, b, n in counted if of_g == g):
                if n >= state[g][2]:
                    state[g] = [bin_ << finer, finer, state[g][2], n]
                    break
                state[g][2] -= n
    before = any_of([F.col("_g").eqNullSafe(F.lit(g)) & (key < s[0]) for g, s in state.items()])
    between = any_of([in_range(g, key) for g in state])
    near = number_rows(named.where(between), ["_g", *[f"_o{i}" for i in range(len(order))], *ties], "_i", start=0)
    starts = near.groupBy("_g").agg(F.min("_i").alias("_s"))
    near = near.join(F.broadcast(starts.withColumnRenamed("_g", "_gs")), F.col("_g").eqNullSafe(F.col("_gs")))  # one row a group
    rank = F.lit(0).cast("bigint")
    for g, s in state.items():
        rank = F.when(F.col("_g").eqNullSafe(F.lit(g)), F.lit(s[2]).cast("bigint")).otherwise(rank)
    inside = near.withColumn("_in", F.col("_i") - F.col("_s") < rank)
    plain = df.columns
    first = named.where(before).select(plain).unionByName(inside.where("_in").select(plain))
    rest = named.where(~before & ~between).select(plain).unionByName(inside.where(~F.col("_in")).select(plain))
    return first, rest
