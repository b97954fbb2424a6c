"""Whole jobs: the hub-and-spoke load, the unified fire history, training samples, the evaluation of a forecast, the risk map."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberfield import schemas
from emberfield.functions import fire, geometry, grid, time
from emberfield.operators import fires, hubs, metrics, polygons, quality, relational, satellite, scaling, scoring, sequences, splits
from emberfield.session import durable
from emberfield.sources import readers, sinks

# Input file, schema, id column and kept columns of each spoke, in load order.
OBSERVATIONS = {
    "fire": ("fire_sample.csv", schemas.FIRE, "incident_id", ["confidence_score", "source_system", "datetime_record"]),
    "weather": ("weather_sample.csv", schemas.WEATHER, "weather_id",
                ["temperature_c", "wind_speed_kmh", "relative_humidity", "source_system", "datetime_record"]),
    "vegetation": ("vegetation_sample.csv", schemas.VEGETATION, "veg_condition_id",
                   ["dryness_index", "soil_moisture", "vegetation_class", "source_system", "datetime_record"]),
}
STATICS = {
    "topography": ("topography_sample.csv", schemas.TOPOGRAPHY, "topo_id", ["elevation_m", "slope_angle"]),
    "infrastructure": ("infrastructure_sample.csv", schemas.INFRASTRUCTURE, "asset_id", ["facility_name", "risk_category"]),
}
_ORIGINAL = ["original_latitude", "original_longitude"]


def load_hub_and_spoke(spark: SparkSession, source: str, target: str, order: str = "natural") -> DataFrame:
    """Read five CSV files, build both hubs once, align every spoke, check, save; returns the row report."""
    raw_obs = {n: readers.read_csv_typed(spark, f"{source}/{f}", s) for n, (f, s, _, _) in OBSERVATIONS.items()}
    raw_static = {n: readers.read_csv_typed(spark, f"{source}/{f}", s) for n, (f, s, _, _) in STATICS.items()}
    everything = [
        df.withColumnRenamed(spec[2], "_arrival")
        for (n, spec) in [*OBSERVATIONS.items(), *STATICS.items()]
        for df in [(raw_obs | raw_static)[n]]
    ]
    locations = durable(hubs.location_registry(everything, order=order, arrival="_arrival"))
    times = durable(hubs.time_registry(list(raw_obs.values())))
    out = {
        n: durable(hubs.align_observation(raw_obs[n], locations, times, key, [*_ORIGINAL, *keep]))
        for n, (_, _, key, keep) in OBSERVATIONS.items()
    } | {
        n: durable(hubs.align_static(raw_static[n], locations, key, [*_ORIGINAL, *keep]))
        for n, (_, _, key, keep) in STATICS.items()
    }
    for n, df in out.items():
        sinks.write_csv(df, f"{target}/{n}_aligned")
    sinks.write_csv(locations.drop(*hubs.CELL), f"{target}/location_registry")
    sinks.write_csv(times, f"{target}/time_registry")
    checks = [quality.table_check(df).select(F.lit(n).alias("table"), "*") for n, df in out.items()]
    sinks.write_json(hubs.union_all(checks), f"{target}/checks")
    report = durable(sinks.load_report(raw_obs | raw_static, out, {"location_ids": locations, "time_ids": times}))
    sinks.write_json(report, f"{target}/report")
    return report


def _origin(corner: tuple[float, float], cell_m: float) -> tuple[float, float]:
    """The grid's corner: the boundary's, snapped down to the cell size."""
    return (corner[0] // cell_m) * cell_m, (corner[1] // cell_m) * cell_m


def unified_fire_history(
    fire_shapes: DataFrame, detections: DataFrame, corner: tuple[float, float], cell_m: float = 5000.0
) -> tuple[DataFrame, DataFrame]:
    """Fires with their satellite-derived life cycle, and the detections inside fire extents per cell and day.

    ``fire_shapes``: fire_id, ignition_date, area_ha, size_class, ..., rings in degrees.
    ``detections``: the finished satellite table with cell_x, cell_y and datetime, its cells
    counted from ``corner`` in Web-Mercator metres; a detection stands for its whole cell,
    so cells meet fires, and what a cell saw is settled once for all fires in it.
    """
    x0, y0 = _origin(corner, cell_m)
    cx, cy = F.col("cell_x"), F.col("cell_y")
    boxed = detections.withColumns({
        "_w": grid.mercator_lon(cx * cell_m + x0), "_e": grid.mercator_lon((cx + 1) * cell_m + x0),
        "_s": grid.mercator_lat(cy * cell_m + y0), "_n": grid.mercator_lat((cy + 1) * cell_m + y0),
    })
    box = ("_w", "_s", "_e", "_n")
    place = ["cell_x", "cell_y"]
    cells = durable(boxed.select(*place, *box).distinct())
    touched = polygons.boxes_intersect_polygons(
        cells, fire_shapes.select("fire_id", "ignition_date", "rings"), box, "rings", cell_m / 111320.0
    ).drop(*box)
    unified = fires.unify_fires(fire_shapes, durable(touched), detections, place)
    burnt = polygons.boxes_intersect_polygons(cells, fire_shapes.select("rings"), box, "rings", cell_m / 111320.0, "left_semi")
    inside = detections.join(burnt.select(*place), place, "left_semi")
    maxima = [c for c in ("confidence", "is_burning", "burning_neighbors_r1", "burning_neighbors_r2", "is_burning_prev", "is_burning_next",
                          "brightness", "bright_t31", "frp_peak", "frp_cumulative", "frp_prev", "frp_next") if c in inside.columns]
    daily = fires.detections_daily_cell(inside, maxima, ["longitude", "latitude"], ["datetime", "satellite"])
    return unified, daily


def satellite_history(detections: DataFrame, boundary: DataFrame, corner: tuple[float, float], cell_m: float = 5000.0) -> DataFrame:
    """Raw detections inside the boundary to the gridded table with neighbours and targets.

    ``boundary``: rings in degrees; ``corner``: its smallest Web-Mercator x and y. A cell's
    place is the centre of the part of its square that lies inside the boundary.
    """
    inside = polygons.points_in_polygons(detections, boundary.select("rings"), "longitude", "latitude", "rings", 0.25, "left_semi")
    celled = satellite.with_metric_cells(inside, "latitude", "longitude", cell_m, *corner)
    table = durable(satellite.gridded_satellite_table(celled))
    x0, y0 = _origin(corner, cell_m)
    squares = table.select("cell_x", "cell_y").distinct().select("*", *[
        ((F.col(c) + k) * cell_m + o).alias(n) for n, c, k, o in (("w", "cell_x", 0, x0), ("s", "cell_y", 0, y0), ("e", "cell_x", 1, x0), ("n", "cell_y", 1, y0))
    ])
    metric = boundary.select(geometry.map_points(F.col("rings"), lambda lon, lat: (grid.mercator_x(lon), grid.mercator_y(lat))).alias("rings"))
    clipped = polygons.clip_cells(squares, metric, ("w", "s", "e", "n"), "rings", cell_m * 4)
    centres = clipped.select("cell_x", "cell_y", grid.mercator_lon(F.col("centroid_x")).alias("longitude"), grid.mercator_lat(F.col("centroid_y")).alias("latitude"))
    return table.join(centres, ["cell_x", "cell_y"])


def training_samples(
    env: DataFrame, detections: DataFrame, features: list[str], cell: tuple[float, tuple[float, float]], target: str, lookback: int = 60,
    ratio: int = 20, dates: tuple[str, str, str] = splits.SPLIT_DATES, until: str | None = None, order: list[Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Labelled sequences of a classifier from environment rows and fire outlines; returns (samples, scaler parameters) as written to ``target``.

    ``env``: cell_x, cell_y, datetime and the features; rows after ``until`` or with a missing feature are left out, and of rows
    with one cell and time the one with the smallest features stays. ``detections``: rings, date, daynight (0 or 1) and
    is_burning; an outline burns in the cell (of size ``cell[0]``, counted from ``cell[1]``) that holds its centroid.
    A series is a cell within one split, so no sequence reaches into another split. The scaler is fitted on the training
    series that are longer than ``lookback``; each split keeps all burning anchors and ``ratio`` others for each, the first by
    ``order`` over cell_x, cell_y and datetime, else by hash. Only the kept anchors get their sequence ``x``, scaled.
    """
    place = ["cell_x", "cell_y", "datetime"]
    known = env if until is None else env.where(F.col("datetime") <= F.lit(until).cast(time.NTZ))
    spine = known.dropna(subset=[*place, *features]).groupBy(*place).agg(F.min(F.struct(*features)).alias("_f")).select(*place, "_f.*")
    burning = polygons.centroid_in_cell(detections, "rings", *cell).select(
        "cell_x", "cell_y", time.half_day(F.col("date"), F.col("daynight")).alias("datetime"), "is_burning")
    labelled = relational.label_spine_left(spine, burning, place).withColumn("split", splits.time_split_dates(F.col("datetime"), dates))
    rows = durable(labelled.where("split is not null").withColumn("series", F.struct("split", "cell_x", "cell_y")))
    anchors = durable(sequences.lookback_index(rows, "series", "datetime", "is_burning", lookback).select("*", "series.*"))
    sampled = rows.where("split = 'train'").join(anchors.where("split = 'train'").select("series").distinct(), "series", "left_semi")
    sinks.replace_table(scaling.fit_scaler(sampled, features), f"{target}/scaler")
    params = env.sparkSession.read.parquet(f"{target}/scaler")
    chosen = durable(splits.negative_subsample(anchors, "is_burning", place, ratio, order=order, by="split"))
    samples = sequences.materialize_samples(chosen, scaling.apply_scaler(rows, params, features), "series", "datetime", features, "is_burning", lookback)
    sinks.replace_table(samples.select("series.*", "anchor", "is_burning", "x"), f"{target}/samples")
    return env.sparkSession.read.parquet(f"{target}/samples"), params


def evaluate_forecast(
    predictions: DataFrame, labels: DataFrame, inputs: DataFrame, ts: str, cell: list[str], features: list[str], prob: str = "p",
    label: str = "is_burning", beta: float = 2.0,
) -> DataFrame:
    """One row: how a forecast does on the last times, at the threshold that is best on the times before them.

    ``predictions`` and ``labels`` hold each valid cell and time; a cell is valid if ``inputs`` knows any feature of it.
    The splits are those of ``time_split_ratio`` over the times of ``labels``; the scores without skill stand beside.
    """
    mask = durable(sequences.valid_cell_mask(inputs, cell, features))
    placed = splits.time_split_ratio(labels, ts)
    flat = metrics.flatten_valid(predictions, placed, mask, [ts, *cell], cell)
    test = flat.where("split = 'test'")
    threshold = metrics.find_best_threshold(flat.where("split = 'val'"), label, prob, beta).first()["threshold"]
    base = metrics.climatology_baseline(test, label, beta).select(F.struct("*")).scalar()
    return metrics.compute_metrics(test, label, prob, threshold, beta).withColumn("_b", base).select("*", "_b.*").drop("_b")


def forecast_risk_map(
    weather: DataFrame, locations: DataFrame, times: DataFrame, features: list[str], scaler_params: DataFrame,
    scorer: Callable, steps: int = 30, target: str | None = None,
) -> DataFrame:
    """Recent sequences per cell, scaled and scored, as risk factors with cell polygons."""
    source = relational.risk_inputs(weather, locations, times, features)
    scaled = scaling.apply_scaler(source, scaler_params, features)
    position = ["grid_row", "grid_col", "grid_latitude", "grid_longitude"]
    seq = sequences.last_n_sequence(scaled, "location_id", "datetime_record", features, steps, carry=position, strict=True)
    scored = scoring.risk_table(scoring.score_table(seq, scorer, "observations"))
    out = scored.select(
        "location_id", fire.first_horizon_factor(F.col("risk_factor")).alias("risk_factor"),
        grid.cell_polygon(F.col("grid_latitude"), F.col("grid_longitude")).alias("rings"),
    )
    out = durable(out)
    bad = quality.map_contract(out)
    quality.require_no_rows(bad.where("short_rings + open_rings + bad_coordinates + bad_factor > 0"), "risk map breaks its contract")
    if target:
        sinks.replace_table(out.select(geometry.geojson_polygon(F.col("rings")).alias("geometry"), "risk_factor"), target)
    return out
