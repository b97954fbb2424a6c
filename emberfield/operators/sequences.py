"""Series per cell: interpolation, sequences, sliding windows, samples, dense-grid indexes.

Inputs hold one row per (cell, time), so the group of a cell is bounded by the number
of time steps; ``interpolate_time_series`` makes no such assumption and splits long
series into blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emberfield.functions import grid
from emberfield.operators.ordering import number_rows
from emberfield.operators.quality import require_no_rows
from emberfield.session import data_partitions, dealt, durable, sized_broadcast

_BLOCK = 100_000
_SAMPLE_BLOCK = 256  # positions of a series that are gathered in one row for their anchors
_PER_TASK = 16 << 20  # bytes of input files a task
_BLOCKS_PER_TASK = 4 << 20  # the same for rows written in order, which are packed closely and sorted three times


def _carried(summary: DataFrame, groups: list[str], cols: list[str], span: int = 1000) -> DataFrame:
    """Per block the last known value before it (``_cb_``) and the first known after it (``_ca_``).

    Blocks are taken ``span`` at a time: the blocks of a span in one window, then the spans
    in one of their own. Either holds at most ``span`` rows for a series of a hundred billion.
    Where all series together have no more than ``span`` blocks, one window does.
    Both directions are running values from the start of an order, in time linear in the rows.
    """
    def chained(rows: DataFrame, keys: list[str], step: str) -> DataFrame:
        before, after = (Window.partitionBy(*keys).orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.asc(step), F.desc(step)))
        return rows.select(
            "*",
            *[F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_b_{c}") for c in cols],
            *[F.last(f"_first_{c}", ignorenulls=True).over(after).alias(f"_a_{c}") for c in cols],
        )

    if summary.limit(span + 1).count() <= span:
        return chained(summary, groups, "_block").select(*groups, "_block", *[F.col(f"_{x}_{c}").alias(f"_c{x}_{c}") for c in cols for x in "ba"])
    spans = summary.withColumn("_span", F.floor(F.col("_block") / span))
    inside = chained(spans, [*groups, "_span"], "_block")
    whole = spans.groupBy(*groups, "_span").agg(
        *[F.max(f"_last_{c}").alias(f"_last_{c}") for c in cols], *[F.min(f"_first_{c}").alias(f"_first_{c}") for c in cols]
    )
    outside = chained(whole, groups, "_span").select(
        *[F.col(k).alias(f"_s_{k}") for k in [*groups, "_span"]], *[F.col(f"_{x}_{c}").alias(f"_o{x}_{c}") for c in cols for x in "ba"]
    )
    on = F.lit(True)
    for k in [*groups, "_span"]:
        on = on & F.col(k).eqNullSafe(F.col(f"_s_{k}"))
    return inside.join(outside, on).select(
        *groups, "_block", *[F.coalesce(f"_{x}_{c}", f"_o{x}_{c}").alias(f"_c{x}_{c}") for c in cols for x in "ba"]
    )


def interpolate_time_series(
    df: DataFrame, time_col: str, cols: list[str], group_cols: list[str] | None = None,
    direction: str = "forward", tie: list[str] | None = None, block: int = _BLOCK,
) -> DataFrame:
    """Linear interpolation by position in time order.

    'forward' leaves leading nulls and repeats the last value at the end, 'backward'
    the reverse, 'both' fills both ends. Series are cut into blocks of rows; only one
    summary row per block takes part in the carry from block to block. The next known value
    is the last one seen in falling order: a frame that reaches to the end would be gone through for every row.
    """
    if time_col not in df.columns:
        raise KeyError(f"time column '{time_col}' not found")
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    if direction not in ("forward", "backward", "both"):
        raise ValueError("direction must be 'forward', 'backward' or 'both'")
    groups = list(group_cols or [])
    pos = number_rows(df, [*groups, time_col, *(tie or [])], "_pos").withColumn(
        "_block", F.floor(F.col("_pos") / block)
    )

    def known(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.struct(F.col("_pos").alias("p"), F.col(c).cast("double").alias("v")))

    summary = pos.groupBy(*groups, "_block").agg(
        *[F.max(known(c)).alias(f"_last_{c}") for c in cols], *[F.min(known(c)).alias(f"_first_{c}") for c in cols]
    )
    key = F.struct(*groups, "_block").alias("_key")  # one value, so that rows of a null group meet too
    carry = _carried(durable(summary), groups, cols)
    joined = dealt(pos.select("*", key), "_key", per_task=_BLOCKS_PER_TASK).join(
        carry.select(key, *[f"_c{x}_{c}" for c in cols for x in "ba"]), "_key")
    inside = Window.partitionBy("_key")
    upto, onward = (inside.orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in (F.asc("_pos"), F.desc("_pos")))
    filled = {}
    for c in cols:
        a = F.coalesce(F.last(known(c), ignorenulls=True).over(upto), F.col(f"_cb_{c}"))
        b = F.coalesce(F.last(known(c), ignorenulls=True).over(onward), F.col(f"_ca_{c}"))
        span = (b["p"] - a["p"]).cast("double")
        line = a["v"] + (b["v"] - a["v"]) * (F.col("_pos") - a["p"]) / span
        lead = b["v"] if direction in ("backward", "both") else F.lit(None).cast("double")
        tail = a["v"] if direction in ("forward", "both") else F.lit(None).cast("double")
        filled[c] = (
            F.when(F.col(c).isNotNull(), F.col(c).cast("double")).when(a.isNull(), lead).when(b.isNull(), tail).otherwise(line)
        )
    return joined.withColumns(filled).select(*df.columns)


def last_n_sequence(
    df: DataFrame, key: str, ts: str, features: list[str], n: int = 30, carry: list[str] | None = None,
    fill: float | None = None, strict: bool = False,
) -> DataFrame:
    """Newest ``n`` rows per key in time order; keys with fewer rows are left out.

    The rank limit is applied before the shuffle, so a key never sends more than ``n``
    rows per task. ``strict`` raises on a missing feature or when nothing is left.
    """
    newest = Window.partitionBy(key).orderBy(F.desc(ts))
    last = df.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= n)
    if strict:
        gap = F.lit(False)
        for c in [*features, *(carry or [])]:
            gap = gap | F.col(c).isNull()
        full = last.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.bool_or(gap).alias("_gap")).where(F.col("_n") == n)
        require_no_rows(full.where("_gap"), "missing feature or grid position")
        if not full.limit(1).count():
            raise ValueError(f"no key has {n} observations")
    values = [F.coalesce(F.col(c).cast("double"), F.lit(fill).cast("double")) for c in features]
    step = F.struct(F.col(ts).alias("t"), F.array(*values).alias("x"))
    out = last.groupBy(key).agg(
        F.array_sort(F.collect_list(step)).alias("_s"), F.count(F.lit(1)).alias("_n"),
        *[F.max_by(c, ts).alias(c) for c in (carry or [])],
    ).where(F.col("_n") == n)
    return out.select(
        key, *(carry or []), F.transform("_s", lambda s: s["x"]).alias("observations"),
        F.transform("_s", lambda s: s["t"]).alias("timestamps"),
    )


def pad_or_truncate(sequence: Column, n: int, width: int) -> Column:
    """Zeros in front of a short sequence, the newest ``n`` steps of a long one."""
    zero = F.array(*[F.lit(0.0)] * width)
    size = F.size(sequence)
    newest = F.slice(sequence, F.greatest(size - n, F.lit(0)) + 1, F.lit(n))
    return F.concat(F.array_repeat(zero, F.greatest(F.lit(n) - size, F.lit(0))), newest)


def append_forecast_steps(history: Column, forecast: Column) -> Column:
    """History followed by all forecast steps but the last."""
    return F.concat(history, F.slice(forecast, F.lit(1), F.greatest(F.size(forecast) - 1, F.lit(0))))


def sliding_windows(
    df: DataFrame, keys: list[str], ts: str, features: list[str], steps: int, horizon: int
) -> DataFrame:
    """Samples per series: ``steps`` rows of input, the ``horizon`` rows after them as target.

    ``sample`` counts from 0; a series of T rows gives T - steps - horizon + 1 samples.
    """
    order = Window.partitionBy(*keys).orderBy(ts)
    x = F.array(*[F.col(f).cast("double") for f in features])
    framed = df.select(
        *keys, ts, (F.row_number().over(order) - 1 - steps).alias("sample"),
        F.collect_list(x).over(order.rowsBetween(-steps, -1)).alias("x"),
        F.collect_list(x).over(order.rowsBetween(0, horizon - 1)).alias("y"),
    )
    return framed.where((F.size("x") == steps) & (F.size("y") == horizon))


def sample_index(steps_total: DataFrame, total: str, steps: int, horizon: int) -> DataFrame:
    """Long form of the windows of a dense tensor: (sample, role, offset, t_idx), nothing copied."""
    n = F.col(total) - steps - horizon + 1
    samples = steps_total.where(n > 0).select(F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)).alias("sample"))
    rel = F.explode(F.sequence(F.lit(0), F.lit(steps + horizon - 1))).alias("_o")
    return samples.repartition("sample").select("sample", rel).select(
        "sample", F.when(F.col("_o") < steps, "x").otherwise("y").alias("role"),
        F.when(F.col("_o") < steps, F.col("_o")).otherwise(F.col("_o") - steps).alias("offset"),
        (F.col("sample") + F.col("_o")).alias("t_idx"),
    )


def lookback_index(df: DataFrame, key: str, ts: str, label: str, lookback: int = 60) -> DataFrame:
    """Anchors (key, position, label) of series with more than ``lookback`` rows; no arrays yet."""
    order = Window.partitionBy(key).orderBy(ts)
    numbered = df.where(F.col(key).isNotNull()).select(key, ts, label, (F.row_number().over(order) - 1).alias("idx"))
    return numbered.where(F.col("idx") >= lookback)


def materialize_samples(
    anchors: DataFrame, df: DataFrame, key: str, ts: str, features: list[str], label: str, lookback: int = 60
) -> DataFrame:
    """Sequences of the chosen anchors only; an anchor with no row before it has none.

    Series are cut into blocks of positions, each with the ``lookback`` rows before it as well, so an anchor finds its whole
    sequence in the row of its block and nothing is copied per anchor before that. Block and anchors meet in one grouping,
    dealt by the size of the input: no join whose side could be broadcast.
    """
    block = max(lookback, _SAMPLE_BLOCK)  # a row serves two blocks at most
    order = Window.partitionBy(key).orderBy(ts)
    values = F.array(*[F.col(f).cast("double") for f in features])
    rows = dealt(df, key).where(F.col(key).isNotNull()).select(key, (F.row_number().over(order) - 1).cast("bigint").alias("idx"), values.alias("x"))
    served = F.explode(F.sequence(F.floor(F.col("idx") / block), F.floor((F.col("idx") + lookback) / block))).alias("_block")
    steps = rows.select(key, served, F.struct("idx", "x").alias("_step"))
    asked = anchors.where(F.col(key).isNotNull() & F.col("idx").isNotNull()).select(
        key, F.floor(F.col("idx") / block).alias("_block"), F.struct(F.col("idx").alias("anchor"), label).alias("_anchor"))
    both = steps.unionByName(asked, allowMissingColumns=True)
    met = both.repartition(data_partitions(both, _PER_TASK), key, "_block").groupBy(key, "_block").agg(
        F.array_sort(F.collect_list("_step")).alias("_steps"), F.collect_set("_anchor").alias("_anchors"))
    each = met.where((F.size("_anchors") > 0) & (F.size("_steps") > 0)).select(key, F.explode("_anchors").alias("_a"), "_steps")
    first, anchor = F.get("_steps", F.lit(0))["idx"], F.col("_a.anchor")
    start = F.greatest(anchor - lookback, first)
    sequence = F.slice("_steps", (start - first + 1).cast("int"), F.greatest(anchor - start, F.lit(0)).cast("int"))
    out = each.select(key, "_a.anchor", F.col(f"_a.{label}").alias(label), F.transform(sequence, lambda s: s["x"]).alias("x"))
    return out.where(F.size("x") > 0)


def label_grid(detections: DataFrame, times: DataFrame, height: int, width: int) -> tuple[DataFrame, DataFrame]:
    """Burning cells (t_idx, row, col) on the time axis, and counts of what fell outside it."""
    joined = detections.join(sized_broadcast(times), "datetime", "left")
    on_axis = F.col("t_idx").isNotNull()
    in_grid = F.col("cell_y").between(0, height - 1) & F.col("cell_x").between(0, width - 1)
    placed = joined.where(on_axis & in_grid).select(
        "t_idx", F.col("cell_y").alias("row"), F.col("cell_x").alias("col")
    ).distinct()
    counts = joined.agg(
        F.count_if(on_axis & in_grid).alias("placed"), F.count_if(~on_axis).alias("out_of_window"),
        F.count_if(on_axis & ~in_grid).alias("out_of_bounds"),
    )
    return placed, counts


def time_axis(df: DataFrame, ts: str) -> DataFrame:
    """Distinct times with their index from 0."""
    return number_rows(df.select(F.col(ts).alias("datetime")).where("datetime is not null").distinct(), ["datetime"], "t_idx", 0)


def tensor_long(
    df: DataFrame, times: DataFrame, ts: str, lat: str, lon: str, features: list[str], order: list[str]
) -> DataFrame:
    """Cells of the dense tensor as rows keyed (t_idx, row, col); the later duplicate wins."""
    valid = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    rows = number_rows(valid.select(lat).distinct(), [lat], "row", start=0)
    cols = number_rows(valid.select(lon).distinct(), [lon], "col", start=0)
    keyed = (
        valid.withColumn("datetime", F.col(ts)).join(sized_broadcast(times), "datetime")
        .join(sized_broadcast(rows), lat).join(sized_broadcast(cols), lon)
    )
    last = F.max_by(F.struct(*features), F.struct(*order))
    return keyed.groupBy("t_idx", "row", "col").agg(last.alias("f")).select("t_idx", "row", "col", "f.*")


def valid_cell_mask(df: DataFrame, cell: list[str], features: list[str]) -> DataFrame:
    """Cells with any feature known at any time."""
    known = F.lit(False)
    for f in features:
        known = known | F.col(f).isNotNull()
    return df.where(known).select(*cell).distinct()


def days_since_rain(df: DataFrame, cell: str, day: str, rain: str, threshold: float = 1.0) -> DataFrame:
    """Consecutive days up to each day without meaningful rain (rows must be daily per cell)."""
    w = Window.partitionBy(cell).orderBy(day)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    wet = F.max(F.when(F.col(rain) >= threshold, F.col(day))).over(upto)
    start = F.min(day).over(upto)
    dry = F.when(wet.isNotNull(), F.datediff(F.col(day), wet)).otherwise(F.datediff(F.col(day), start) + 1)
    return df.withColumn("days_since_rain", dry)


def recent_grid_request(
    df: DataFrame, row: str, col: str, lat: str, lon: str, ts: str, features: list[str], n: int, half: float = 0.025
) -> DataFrame:
    """Last ``n`` steps of every valid cell, missing values as 0, with id and cell polygon."""
    mask = valid_cell_mask(df, [row, col], features)
    kept = df.join(mask, [row, col], "left_semi").withColumn(
        "id", F.concat_ws("_", F.lit("cell"), F.col(row).cast("string"), F.col(col).cast("string"))
    )
    seq = last_n_sequence(kept, "id", ts, features, n, carry=[row, col, lat, lon], fill=0.0)
    return seq.withColumn("rings", grid.cell_polygon(F.col(lat), F.col(lon), half))
