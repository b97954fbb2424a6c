"""Location and time hubs, alignment of observations to them, and grid generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberfield.functions import geometry, grid, time
from emberfield.operators import polygons
from emberfield.operators.ordering import number_rows
from emberfield.session import sized_broadcast

CELL = ["lat_idx", "lon_idx"]


def with_cell(df: DataFrame, lat: str, lon: str, size: float = 0.1) -> DataFrame:
    """Add the integer cell key; joins use it instead of fragile floating-point coordinates."""
    return df.withColumns({
        "lat_idx": grid.cell_index(F.col(lat), size),
        "lon_idx": grid.cell_index(F.col(lon), size),
    })


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def location_registry(
    sources: list[DataFrame],
    lat: str = "original_latitude",
    lon: str = "original_longitude",
    size: float = 0.1,
    box: grid.Box = grid.STATE_BOX,
    order: str = "natural",
    arrival: str | None = None,
) -> DataFrame:
    """Distinct snapped cells with ids.

    ``order='natural'`` numbers cells south-west to north-east; ``'first_seen'``
    follows the sources in list order and ``arrival`` inside each source.
    """
    parts = []
    for i, df in enumerate(sources):
        seen = F.col(arrival).cast("bigint") if arrival else F.lit(0).cast("bigint")
        parts.append(
            with_cell(df.where(grid.in_bounds(F.col(lat), F.col(lon), box)), lat, lon, size)
            .select(*CELL, F.struct(F.lit(i).alias("src"), seen.alias("ord")).alias("seen"))
        )
    cells = union_all(parts).groupBy(*CELL).agg(F.min("seen").alias("seen"))
    keys = ["seen", *CELL] if order == "first_seen" else CELL
    glat, glon = F.col("lat_idx") * F.lit(size), F.col("lon_idx") * F.lit(size)
    return number_rows(cells, keys, "location_id").select(
        "location_id", *CELL, glat.alias("grid_latitude"), glon.alias("grid_longitude"),
        grid.region_nearest_euclid(glat, glon).alias("region_name"),
    )


def time_registry(
    sources: list[DataFrame],
    ts: str = "datetime_record",
    lat: str = "original_latitude",
    lon: str = "original_longitude",
    box: grid.Box = grid.STATE_BOX,
) -> DataFrame:
    """Distinct hours of the in-bounds rows, numbered in time order, with the season."""
    hours = union_all([
        df.where(grid.in_bounds(F.col(lat), F.col(lon), box)).select(time.floor_hour(F.col(ts)).alias("datetime_record"))
        for df in sources
    ]).distinct()
    return number_rows(hours, ["datetime_record"], "time_id").select(
        "time_id", "datetime_record", time.season(F.col("datetime_record")).alias("season")
    )


def align_observation(
    df: DataFrame, locations: DataFrame, times: DataFrame, id_col: str, keep: list[str],
    ts: str = "datetime_record", lat: str = "original_latitude", lon: str = "original_longitude",
    size: float = 0.1, box: grid.Box = grid.STATE_BOX,
) -> DataFrame:
    """Observation rows keyed by both hubs; rows out of bounds are dropped."""
    inside = with_cell(df.where(grid.in_bounds(F.col(lat), F.col(lon), box)), lat, lon, size)
    hours = times.select("time_id", F.col("datetime_record").alias("_hour"))
    return (
        inside.withColumn("_hour", time.floor_hour(F.col(ts)))
        .join(sized_broadcast(locations.select("location_id", *CELL)), CELL)
        .join(sized_broadcast(hours), "_hour")
        .select(id_col, "location_id", "time_id", *keep)
    )


def align_static(
    df: DataFrame, locations: DataFrame, id_col: str, keep: list[str],
    lat: str = "original_latitude", lon: str = "original_longitude",
    size: float = 0.1, box: grid.Box = grid.STATE_BOX,
) -> DataFrame:
    inside = with_cell(df.where(grid.in_bounds(F.col(lat), F.col(lon), box)), lat, lon, size)
    cells = sized_broadcast(locations.select("location_id", *CELL))
    return inside.join(cells, CELL).select(id_col, "location_id", *keep)


def get_or_create_locations(
    df: DataFrame, registry: DataFrame, lat: str, lon: str, size: float = 0.1,
    box: grid.Box = grid.REGISTRY_BOX, region: str = "Victoria",
) -> DataFrame:
    """Registry extended by the unseen in-bounds cells of ``df``, ids continuing from its maximum."""
    cells = with_cell(df.where(grid.in_bounds(F.col(lat), F.col(lon), box)), lat, lon, size).select(*CELL).distinct()
    fresh = number_rows(cells.join(registry, CELL, "left_anti"), CELL, "_n", start=1)
    top = registry.agg(F.coalesce(F.max("location_id"), F.lit(0))).scalar()
    added = fresh.select(
        (top + F.col("_n")).alias("location_id"), *CELL,
        F.round(F.col("lat_idx") * F.lit(size), 4).alias("grid_latitude"),
        F.round(F.col("lon_idx") * F.lit(size), 4).alias("grid_longitude"),
        F.lit(region).alias("region_name"),
    )
    return registry.select(*added.columns).unionByName(added)


def minute_registry(bounds: DataFrame, start: str = "start", stop: str = "stop") -> DataFrame:
    """Every minute from ``start`` to ``stop`` (exclusive) with its season, days spread over tasks."""
    day = F.explode(F.sequence(
        time.floor_day(F.col(start)), time.floor_day(F.col(stop)), F.expr("interval 1 day")
    )).alias("day")
    days = bounds.select(start, stop, day).repartition("day")
    last = F.col("day") + F.expr("interval '23:59' hour to minute")
    minutes = days.select(start, stop, F.explode(F.sequence("day", last, F.expr("interval 1 minute"))).alias("m"))
    kept = minutes.where((F.col("m") >= F.col(start)) & (F.col("m") < F.col(stop)))
    return kept.select(
        time.hour_id(F.col("m")).alias("hour_id"), F.col("m").alias("datetime_record"),
        time.season(F.col("m")).alias("season"),
    )


def generate_grid(boundaries: DataFrame, key: str, rings: str, cell: float) -> DataFrame:
    """Cells of side ``cell`` that intersect each boundary, rows and columns from the south-west.

    The grid is the bucket grid of ``polygons.polygon_cells``: each edge finds the cells it
    touches, and rows of the outline's crossings give those inside, so no task holds an outline.
    """
    b, size = F.col("c._b"), F.lit(float(cell))
    cells = polygons.polygon_cells(boundaries.select(key, rings), rings, cell).alias("c")
    west, south = F.floor(b["x0"] / size), F.floor(b["y0"] / size)
    placed = cells.select(
        "*", (F.col("bx") - west).cast("int").alias("col"), (F.col("by") - south).cast("int").alias("row"),
        (west * size + (F.col("bx") - west) * size).alias("x0"), (south * size + (F.col("by") - south) * size).alias("y0"),
        F.ceil((b["x1"] - west * size) / size).alias("_cols"), F.ceil((b["y1"] - south * size) / size).alias("_rows"),
    ).alias("c")
    within = (F.col("col") >= 0) & (F.col("row") >= 0) & (F.col("col") < F.greatest("_cols", F.lit(1))) & (F.col("row") < F.greatest("_rows", F.lit(1)))
    x0, y0 = F.col("x0"), F.col("y0")
    hit = geometry.edges_touch_box(F.col("_e"), x0, y0, x0 + size, y0 + size) | polygons.bucket_contains("c", x0 + size / 2, y0 + size / 2)
    return placed.where(within & hit).select(key, "row", "col", "x0", "y0")


def cell_attributes(cells: DataFrame, cell: float, prefix: str = "VIC", to_latlon=grid.vicgrid_inverse) -> DataFrame:
    """Text id, centroid in degrees and area in hectares of projected cells (corner x0, y0)."""
    half = F.lit(cell / 2)
    lat, lon = to_latlon(F.col("x0") + half, F.col("y0") + half)
    return cells.select(
        "*",
        F.format_string(f"{prefix}_{int(cell)}M_%05d_%05d", F.col("row"), F.col("col")).alias("cell_id"),
        F.round(lon, 6).alias("centroid_lon"), F.round(lat, 6).alias("centroid_lat"),
        F.round(F.lit(cell * cell / 10000.0), 4).alias("cell_area_ha"),
    )


def grid_from_lines(lines: DataFrame, vertices: str, significance: str, minimum: int) -> DataFrame:
    """Distinct vertices of the lines at or above a significance."""
    pts = lines.where(F.col(significance) >= minimum).select(F.explode(vertices).alias("v"))
    return pts.select(F.col("v.x").alias("lon"), F.col("v.y").alias("lat")).distinct()


def coarse_mesh(bounds: DataFrame, km: float, reference_lat: float = 37.0) -> DataFrame:
    """Regular mesh over boxes (south, north, west, east), steps set in kilometres."""
    step_lat = F.lit(km / 111.0)
    step_lon = F.lit(km / 111.0) / F.cos(F.radians(F.lit(reference_lat)))
    n_lat = F.floor((F.col("north") - F.col("south")) / step_lat).cast("int")
    n_lon = F.floor((F.col("east") - F.col("west")) / step_lon).cast("int")
    rows = bounds.select("*", F.explode(F.sequence(F.lit(0), n_lat)).alias("mesh_row"))
    both = rows.select("*", F.explode(F.sequence(F.lit(0), n_lon)).alias("mesh_col"))
    return both.select(
        "mesh_row", "mesh_col",
        (F.col("south") + F.col("mesh_row") * step_lat).alias("lat"),
        (F.col("west") + F.col("mesh_col") * step_lon).alias("lon"),
    )


def grid_row_col(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Row and column index of each coordinate pair: rank of its latitude and longitude.

    Both axes are distinct tables first, so the numbering runs on grid lines, not rows.
    """
    valid = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    rows = number_rows(valid.select(lat).distinct(), [lat], "row", start=0)
    cols = number_rows(valid.select(lon).distinct(), [lon], "col", start=0)
    return valid.join(sized_broadcast(rows), lat).join(sized_broadcast(cols), lon)


def snapped_center(lat: Column, lon: Column, size: float = 0.05) -> tuple[Column, Column]:
    return grid.snap_floor_center(lat, size), grid.snap_floor_center(lon, size)
