"""Gridded satellite passes: aggregation, pass times, burning neighbours, previous and next state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emberfield.functions import fire, grid, time
from emberfield.operators.ordering import previous_row
from emberfield.session import durable

PASS_KEYS = ["grid_id", "cell_x", "cell_y", "acq_date", "daynight", "satellite"]


def with_metric_cells(detections: DataFrame, lat: str, lon: str, size: float, xmin: float, ymin: float) -> DataFrame:
    """Web-Mercator cells counted from the boundary's corner snapped down to the cell size."""
    x0, y0 = (xmin // size) * size, (ymin // size) * size
    out = detections.withColumns({
        "cell_x": grid.metric_cell(grid.mercator_x(F.col(lon)), x0, size),
        "cell_y": grid.metric_cell(grid.mercator_y(F.col(lat)), y0, size),
    })
    return out.withColumn("grid_id", grid.cell_number(F.col("cell_x"), F.col("cell_y")))


def combine_satellites(viirs: list[DataFrame], modis: DataFrame) -> DataFrame:
    """Union by name after banding the numeric confidence of the one product that has it."""
    banded = modis.withColumn("confidence", fire.modis_confidence_band(F.col("confidence")))
    out = banded
    for df in viirs:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def grid_pass_agg(detections: DataFrame) -> DataFrame:
    """One row per cell, day, half-day and satellite; rows with a NULL key are dropped."""
    coded = detections.withColumn("confidence", fire.confidence_code(F.col("confidence")))
    return coded.dropna(subset=PASS_KEYS).groupBy(*PASS_KEYS).agg(
        F.max("brightness").alias("brightness"), F.max("bright_t31").alias("bright_t31"),
        F.max("frp").alias("frp_peak"), F.coalesce(F.sum("frp"), F.lit(0.0)).alias("frp_cumulative"),
        F.max("confidence").alias("confidence"), F.max("acq_time").alias("acq_time"),
    )


def pass_datetime(cells: DataFrame) -> DataFrame:
    """Add ``datetime`` and the start of the satellite's pass (a small aggregate joined back)."""
    dated = cells.withColumn("datetime", time.pass_time(F.col("acq_date"), F.col("acq_time")))
    keys = ["satellite", "acq_date", "daynight"]
    passes = dated.groupBy(*keys).agg(F.min("datetime").alias("pass_datetime"))
    return dated.join(passes, keys)


def time_since_prev_pass(cells: DataFrame, per_satellite: bool = False) -> DataFrame:
    """Seconds since the previous pass of any satellite, or of the same one, 0 for the first; ties follow the satellite."""
    passes = cells.select("pass_datetime", "satellite").distinct()
    if per_satellite:
        prev = previous_row(passes, ["satellite", "pass_datetime"], {"prev_pass_datetime": "pass_datetime", "_of": "satellite"})
        same = F.col("_of").eqNullSafe(F.col("satellite"))
        prev = prev.withColumn("prev_pass_datetime", F.when(same, F.col("prev_pass_datetime"))).drop("_of")
    else:
        prev = previous_row(passes, ["pass_datetime", "satellite"], {"prev_pass_datetime": "pass_datetime"})
    gap = time.seconds_between(F.col("prev_pass_datetime"), F.col("pass_datetime"))
    return cells.join(prev, ["pass_datetime", "satellite"], "left").withColumn(
        "time_since_prev_pass", F.coalesce(gap, F.lit(0.0))
    )


def burning_neighbors(cells: DataFrame, radii: tuple[int, ...] = (1, 2)) -> DataFrame:
    """Burning neighbours per radius, in the same pass (own row excluded) and the pass before.

    Rows are first summed per (pass, cell). Each sum is copied to the grid rows within
    reach (2r+1 copies, not (2r+1) squared) and a range window along x finishes the
    square, so one shuffle serves all radii and both passes; a window group is one
    grid row of one pass and is bounded by the width of the grid.
    """
    reach = max(radii)
    sums = cells.groupBy("pass_datetime", "cell_x", "cell_y").agg(
        F.sum("is_burning").alias("burning"), F.count(F.lit(1)).alias("rows")
    )
    passes = sums.select("pass_datetime").distinct()
    nxt = previous_row(passes, ["pass_datetime"], {"before": "pass_datetime"}).where(F.col("before").isNotNull())
    following = nxt.select(F.col("before").alias("pass_datetime"), F.col("pass_datetime").alias("target"))
    zero = F.lit(0).cast("bigint")
    now = sums.select(
        "pass_datetime", "cell_x", "cell_y", "burning", zero.alias("previous"), F.lit(True).alias("own")
    )
    earlier = sums.join(following, "pass_datetime").select(
        F.col("target").alias("pass_datetime"), "cell_x", "cell_y", zero.alias("burning"),
        F.col("rows").alias("previous"), F.lit(False).alias("own"),
    )
    spread = now.unionByName(earlier).select(
        "*", F.explode(F.array(*[F.lit(d) for d in range(-reach, reach + 1)])).alias("dy")
    ).select(
        "pass_datetime", (F.col("cell_y") + F.col("dy")).alias("cell_y"), "cell_x", "burning", "previous", "dy",
        (F.col("own") & (F.col("dy") == 0)).alias("own"),
    )
    line = Window.partitionBy("pass_datetime", "cell_y").orderBy("cell_x")
    counts = {}
    for r in radii:
        near = F.abs("dy") <= r
        w = line.rangeBetween(-r, r)
        counts[f"_now_{r}"] = F.sum(F.when(near, F.col("burning")).otherwise(0)).over(w)
        counts[f"burning_neighbors_prev_r{r}"] = F.sum(F.when(near, F.col("previous")).otherwise(0)).over(w)
    per_cell = spread.withColumns(counts).where("own").select("pass_datetime", "cell_x", "cell_y", *counts)
    joined = cells.join(per_cell, ["pass_datetime", "cell_x", "cell_y"])
    for r in radii:
        joined = joined.withColumn(f"burning_neighbors_r{r}", F.col(f"_now_{r}") - F.col("is_burning")).drop(f"_now_{r}")
    return joined


def cell_lag_lead(cells: DataFrame) -> DataFrame:
    """Burning flag and power of the cell's previous and next row, 0 where there is none.

    The input holds one row per cell, pass and satellite, so a cell's group is bounded
    by the number of passes.
    """
    w = Window.partitionBy("cell_x", "cell_y").orderBy("pass_datetime", "satellite")
    keyed = cells.dropna(subset=["cell_x", "cell_y"])
    zero = F.lit(0)
    return keyed.withColumns({
        "is_burning_prev": F.coalesce(F.lag("is_burning").over(w), zero).cast("int"),
        "frp_prev": F.coalesce(F.lag("frp_peak").over(w), F.lit(0.0)),
        "is_burning_next": F.coalesce(F.lead("is_burning").over(w), zero).cast("int"),
        "frp_next": F.coalesce(F.lead("frp_peak").over(w), F.lit(0.0)),
    })


def gridded_satellite_table(detections: DataFrame) -> DataFrame:
    """Detections with cells to the finished training table. They are read once: later steps meet only their rows by cell and pass, stored."""
    cells = pass_datetime(durable(grid_pass_agg(detections))).withColumn("is_burning", F.lit(1))
    cells = cell_lag_lead(burning_neighbors(durable(time_since_prev_pass(cells))))
    return cells.withColumn("daynight", fire.daynight_code(F.col("daynight")))
