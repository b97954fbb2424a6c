"""Fire life cycle: ids, detection windows, end dates, severity, status, per-cell statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emberfield.functions import time
from emberfield.operators.ordering import number_rows
from emberfield.session import data_partitions, dealt, durable, shuffle_partitions

_PER_TASK = 16 << 20  # bytes of input files a task


def synthetic_fire_ids(fires: DataFrame, order: list[str], fire_id: str = "fire_id") -> DataFrame:
    """NULL ids become -1, -2, ... in ``order``."""
    known = fires.where(F.col(fire_id).isNotNull())
    unnamed = number_rows(fires.where(F.col(fire_id).isNull()), order, "_n")
    filled = unnamed.withColumn(fire_id, (-F.col("_n")).cast(fires.schema[fire_id].dataType)).drop("_n")
    return known.unionByName(filled)


def temporal_window_filter(
    detections: DataFrame, before_days: int = 1, after_days: int = 120, first_within_days: int = 4
) -> DataFrame:
    """Detections around ignition, for fires first seen soon enough.

    Columns used: fire_id, datetime, ignition_date. The first kept detection per fire
    is a small aggregate joined back, so one large fire does not fill one task.
    """
    t, ign = F.col("datetime"), F.col("ignition_date")
    kept = detections.where((t >= time.plus_days(ign, -before_days)) & (t <= time.plus_days(ign, after_days)))
    first = kept.groupBy("fire_id").agg(F.min("datetime").alias("first_detection"))
    return kept.join(first, "fire_id").where(
        F.col("first_detection") <= time.plus_days(ign, first_within_days)
    ).drop("first_detection")


def first_detection_per_fire(detections: DataFrame) -> DataFrame:
    first = detections.groupBy("fire_id").agg(F.min("datetime").alias("first_detection"))
    return detections.join(first, "fire_id")


def estimate_extinguish(detections: DataFrame, gap_days: float = 4) -> DataFrame:
    """First detection followed by a longer gap than ``gap_days``, or by nothing.

    Only distinct detection times matter, which bounds a fire's group by the minutes
    of its detection window whatever the number of detections.
    """
    times = detections.where(F.col("datetime").isNotNull()).select("fire_id", "datetime").distinct()
    nxt = F.lead("datetime").over(Window.partitionBy("fire_id").orderBy("datetime"))
    gaps = times.withColumn("_next", nxt)
    is_gap = F.col("_next").isNull() | (
        time.seconds_between(F.col("datetime"), F.col("_next")) / 86400 > gap_days
    )
    return gaps.groupBy("fire_id").agg(F.min(F.when(is_gap, F.col("datetime"))).alias("extinguish_date"))


def late_ignition(ignition: Column, extinguish: Column) -> Column:
    """An end before the recorded ignition becomes six hours after it."""
    return F.when(extinguish < ignition, time.plus_hours(ignition, 6)).otherwise(extinguish)


def duration_days(ignition: Column, extinguish: Column) -> Column:
    return F.round(time.seconds_between(ignition, extinguish) / 86400, 2)


def fire_frp_severity(detections: DataFrame) -> DataFrame:
    """Peak and cumulative power per detected fire."""
    return detections.groupBy("fire_id").agg(
        F.max("frp_peak").alias("peak_frp"),
        F.coalesce(F.sum("frp_cumulative"), F.lit(0.0)).alias("cumulative_frp"),
    )


def detection_count_status(fires: DataFrame, detections: DataFrame) -> DataFrame:
    counts = detections.groupBy("fire_id").agg(F.count("datetime").alias("viirs_detection_count"))
    n = F.coalesce("viirs_detection_count", F.lit(0).cast("bigint"))
    return fires.join(counts, "fire_id", "left").withColumns({
        "viirs_detection_count": n,
        "detection_status": F.when(n == 0, "never_detected").otherwise("detected"),
    })


def impute_undetected(fires: DataFrame) -> DataFrame:
    """Undetected small fires burn six hours; undetected large ones are a coverage gap."""
    missed = F.col("detection_status") == "never_detected"
    small = missed & F.col("size_class").isin("small", "medium")
    large = missed & F.col("size_class").isin("large", "mega")
    small = F.coalesce(small, F.lit(False))
    return fires.withColumns({
        "extinguish_date": F.when(small, time.plus_hours(F.col("ignition_date"), 6)).otherwise(F.col("extinguish_date")),
        "duration_days": F.when(small, F.lit(0.25)).otherwise(F.col("duration_days")),
        "detection_status": F.when(small, "imputed_same_day").when(large, "coverage_gap").otherwise(
            F.col("detection_status")
        ),
    })


def life_by_place(
    touched: DataFrame, detections: DataFrame, place: list[str], before_days: int = 1, after_days: int = 120,
    first_within_days: int = 4, gap_days: float = 4,
) -> tuple[DataFrame, DataFrame]:
    """Measures and end dates as of ``temporal_window_filter`` and ``estimate_extinguish``, without a row per fire and detection.

    ``touched``: a row per fire and place (fire_id, ignition_date, ``place``), which stands for all detections of that place.
    What a place saw in the window of an ignition is settled once for all fires that ignited then. Of times no further
    apart than the gap only the first and the last in the window are kept; such spans of several places make a fire's own.
    """
    t, ign = F.col("datetime"), F.col("ignition_date")
    apart = lambda a, b: time.seconds_between(a, b) / 86400 > gap_days
    days = before_days + after_days + 6  # spans at most two blocks of days, a day more on both sides for hours and zones
    block = lambda day, more: F.floor((F.datediff(F.to_date(day), F.lit("1970-01-01").cast("date")) + more) / days)
    seen = detections.where(t.isNotNull()).groupBy(*place, "datetime").agg(
        F.max("frp_peak").alias("_peak"), F.sum("frp_cumulative").alias("_power"), F.count(F.lit(1)).alias("_n"))
    line = Window.partitionBy(*place).orderBy("datetime")
    jumps = seen.withColumn("_jump", F.when(apart(F.lag("datetime").over(line), t), 1).otherwise(0))
    series = jumps.withColumn("_run", F.sum("_jump").over(line.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_block", block("datetime", 0))
    touched = dealt(touched.select("fire_id", "ignition_date", *place), *place, "ignition_date")
    starts = touched.select(*place, "ignition_date").distinct()
    spread = starts.select("*", F.explode(F.sequence(block("ignition_date", -before_days - 1), block("ignition_date", after_days + 1))).alias("_block"))
    hits = spread.join(series, [*place, "_block"]).where((t >= time.plus_days(ign, -before_days)) & (t <= time.plus_days(ign, after_days)))
    runs = hits.groupBy(*place, "ignition_date", "_run").agg(
        F.min("datetime").alias("_from"), F.max("datetime").alias("_to"), F.max("_peak").alias("_peak"), F.sum("_power").alias("_power"), F.sum("_n").alias("_n"))
    sums = [F.max("_peak").alias("_peak"), F.sum("_power").alias("_power"), F.sum("_n").alias("_n")]
    spans = runs.groupBy(*place, "ignition_date").agg(F.min("_from").alias("_first"), *sums, F.collect_list(F.struct("_from", "_to")).alias("_runs"))
    met = dealt(durable(touched.join(spans, [*place, "ignition_date"]).drop(*place)), "fire_id")
    first = met.groupBy("fire_id").agg(F.min("_first").alias("first_detection"))
    kept = met.join(first, "fire_id").where(F.col("first_detection") <= time.plus_days(ign, first_within_days))
    measures = kept.groupBy("fire_id").agg(*sums).select(
        "fire_id", F.col("_peak").alias("peak_frp"), F.coalesce("_power", F.lit(0.0)).alias("cumulative_frp"), F.col("_n").alias("viirs_detection_count"))
    own = kept.select("fire_id", F.explode("_runs").alias("_r")).select("fire_id", "_r.*").distinct()
    before = F.max("_to").over(Window.partitionBy("fire_id").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1))
    ended = own.withColumn("_before", before).groupBy("fire_id").agg(
        F.min(F.when(apart(F.col("_before"), F.col("_from")), F.col("_before"))).alias("_end"), F.max("_to").alias("_to"))
    return measures, ended.select("fire_id", F.coalesce("_end", "_to").alias("extinguish_date"))


def unify_fires(fires: DataFrame, matched: DataFrame, detections: DataFrame | None = None, place: list[str] | None = None) -> DataFrame:
    """Fires with end date, duration, severity and status from their matched detections.

    ``matched`` has a row per fire and detection; or, with ``detections``, one per fire and ``place``, for all detections there.
    All per-fire measures come from one aggregate and the end dates from one window,
    then two left joins on the fire id.
    """
    if detections is None:
        kept = temporal_window_filter(matched)
        ends = estimate_extinguish(kept)
        measures = kept.groupBy("fire_id").agg(
            F.max("frp_peak").alias("peak_frp"),
            F.coalesce(F.sum("frp_cumulative"), F.lit(0.0)).alias("cumulative_frp"),
            F.count("datetime").alias("viirs_detection_count"),
        )
    else:
        measures, ends = life_by_place(matched, detections, place)
    parts = max(data_partitions(fires, _PER_TASK), data_partitions(matched, _PER_TASK))
    if parts > shuffle_partitions(fires.sparkSession):
        fires = fires.repartition(parts, "fire_id")  # the joins below, and those with the result, follow it
    out = fires.join(measures, "fire_id", "left").join(ends, "fire_id", "left")
    n = F.coalesce("viirs_detection_count", F.lit(0).cast("bigint"))
    end = late_ignition(F.col("ignition_date"), F.col("extinguish_date"))
    out = out.withColumns({
        "viirs_detection_count": n, "extinguish_date": end,
        "detection_status": F.when(n == 0, "never_detected").otherwise("detected"),
    }).withColumn("duration_days", duration_days(F.col("ignition_date"), F.col("extinguish_date")))
    return impute_undetected(out)


def detections_daily_cell(detections: DataFrame, maxima: list[str], firsts: list[str], order: list[str]) -> DataFrame:
    """Detections per cell, day and half-day: maxima, and the first non-null of other columns."""
    rank = F.struct(*order)
    keyed = detections.withColumn("date", F.to_date("datetime")).dropna(subset=["cell_x", "cell_y", "date", "daynight"])
    out = keyed.groupBy("cell_x", "cell_y", "date", "daynight").agg(
        *[F.max(c).alias(c) for c in maxima],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c) for c in firsts],
    )
    return out.withColumn("datetime", F.col("date").cast(time.NTZ)).drop("date")


def _cents(c: Column) -> Column:
    """Two decimals; rounding to six first removes the noise of the order of summation."""
    return F.round(F.round(c, 6), 2)


def cell_fire_stats(pairs: DataFrame, cell: str = "cell_id", area: str = "whole") -> DataFrame:
    """Statistics per cell over its (fire, cell) pairs; areas are whole-fire areas per touched cell.

    With ``area="share"`` each fire counts with the part of it that lies in the cell: ``overlap_share`` of ``polygons.overlay_areas``.
    """
    if area not in ("whole", "share"):
        raise ValueError("area must be 'whole' or 'share'")
    burned = F.col("area_ha") * F.col("overlap_share") if area == "share" else F.col("area_ha")
    status = F.col("detection_status")
    stats = pairs.where(F.col(cell).isNotNull()).groupBy(cell).agg(
        F.countDistinct("fire_id").alias("fire_count"),
        _cents(F.coalesce(F.sum(burned), F.lit(0.0))).alias("total_area_burned_ha"),
        _cents(F.max("peak_frp")).alias("max_peak_frp"),
        _cents(F.coalesce(F.sum("cumulative_frp"), F.lit(0.0))).alias("total_cumulative_frp"),
        _cents(F.avg("duration_days")).alias("avg_duration_days"),
        F.count_if(status == "detected").alias("fires_detected"),
        F.count_if(status.isin("imputed_same_day", "coverage_gap")).alias("fires_undetected"),
        F.coalesce(F.mode("season", True), F.lit("Unknown")).alias("dominant_season"),
    )
    return stats


def stats_onto_grid(grid_cells: DataFrame, stats: DataFrame, cell: str = "cell_id", cut: bool = True) -> DataFrame:
    """Every grid cell with its statistics; no fire gives 0 and 'None'. Numbers are cut to integers, unless ``cut`` is off."""
    numbers = [
        "fire_count", "total_area_burned_ha", "max_peak_frp", "total_cumulative_frp", "fires_detected", "fires_undetected",
    ]
    joined = grid_cells.join(stats, cell, "left")
    return joined.withColumns({
        **{c: F.coalesce(F.col(c).cast("bigint") if cut else F.col(c), F.lit(0).cast("bigint" if cut else stats.schema[c].dataType)) for c in numbers},
        "dominant_season": F.coalesce("dominant_season", F.lit("None")),
        "avg_duration_days": F.round(F.coalesce("avg_duration_days", F.lit(0.0)), 2),
    })


def grid_fire_summary(cells: DataFrame) -> DataFrame:
    burnt = F.count_if(F.col("fire_count") > 0)
    return cells.agg(
        F.count(F.lit(1)).alias("cells"), burnt.alias("cells_with_fires"),
        F.sum("fire_count").alias("total_fires"), F.sum("total_area_burned_ha").alias("total_area_ha"),
        F.when(burnt > 0, F.sum("fire_count") / burnt).alias("fires_per_burnt_cell"),
        F.sum("fires_detected").alias("detected"), F.sum("fires_undetected").alias("undetected"),
    )


def top_cells(cells: DataFrame, n: int = 10, cell: str = "cell_id") -> DataFrame:
    """The ``n`` cells with most fires, ties by cell id."""
    return cells.select(cell, "fire_count", "total_area_burned_ha").orderBy(F.desc("fire_count"), cell).limit(n)


def season_counts(cells: DataFrame) -> DataFrame:
    return cells.where(F.col("dominant_season") != "None").groupBy("dominant_season").agg(
        F.count(F.lit(1)).alias("cells")
    )


def fire_history_features(pairs: DataFrame, as_of: Column, cell: str = "cell_id") -> DataFrame:
    """Per cell: fires so far, years since the last one, its area and its severity."""
    past = pairs.where(F.col("ignition_date") <= as_of)
    last = F.max_by(F.struct("area_ha", "peak_frp"), F.struct("ignition_date", "fire_id"))
    return past.groupBy(cell).agg(
        F.countDistinct("fire_id").alias("fire_frequency"),
        (F.datediff(as_of, F.max("ignition_date")) / 365.25).alias("years_since_last_fire"),
        last.alias("_last"),
    ).select(
        cell, "fire_frequency", "years_since_last_fire",
        F.col("_last.area_ha").alias("last_area_ha"), F.col("_last.peak_frp").alias("last_severity"),
    )
