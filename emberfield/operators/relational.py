"""Joins of observations, hubs, weather, facilities and forecasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberfield.functions import grid, time
from emberfield.operators import nearest
from emberfield.operators.quality import QualityError
from emberfield.session import durable, sized_broadcast


def incidents_with_hubs(incidents: DataFrame, locations: DataFrame, times: DataFrame) -> DataFrame:
    """Incidents with grid cell, region, hour and season; both hubs must match."""
    loc = locations.select("location_id", "grid_latitude", "grid_longitude", "region_name")
    hour = times.select("time_id", "datetime_record", "season")
    base = incidents.drop("datetime_record", "season")
    return base.join(sized_broadcast(loc), "location_id").join(sized_broadcast(hour), "time_id")


def risk_inputs(weather: DataFrame, locations: DataFrame, times: DataFrame, features: list[str]) -> DataFrame:
    """Model features with hub columns; ordering by location and time is left to the reader."""
    loc = locations.select("location_id", "grid_latitude", "grid_longitude", "grid_row", "grid_col", "region_name")
    hour = times.select("time_id", "datetime_record")
    rows = weather.select("location_id", "time_id", *features)
    return rows.join(sized_broadcast(loc), "location_id").join(sized_broadcast(hour), "time_id")


def fire_event_full(
    incidents: DataFrame, locations: DataFrame, times: DataFrame, weather: DataFrame, vegetation: DataFrame,
    topography: DataFrame, assets: DataFrame,
) -> DataFrame:
    """Left joins of every spoke; several matches fan out, as in the consolidated view.

    Where spokes hold many rows per key, reduce them with ``one_per_key`` first: the output
    grows with the product of their rows.
    """
    def spoke(df: DataFrame, id_col: str, name: str, keys: list[str]) -> DataFrame:
        return df.select(
            *keys, id_col,
            F.col("original_latitude").alias(f"{name}_original_latitude"),
            F.col("original_longitude").alias(f"{name}_original_longitude"),
        )

    both = ["location_id", "time_id"]
    fire = spoke(incidents, "incident_id", "fire", both)
    return (
        fire.join(locations.select("location_id", "grid_latitude", "grid_longitude", "region_name"), "location_id", "left")
        .join(times.select("time_id", "datetime_record", "season"), "time_id", "left")
        .join(spoke(weather, "weather_id", "weather", both), both, "left")
        .join(spoke(vegetation, "veg_condition_id", "vegetation", both), both, "left")
        .join(spoke(topography, "topo_id", "topography", both[:1]), "location_id", "left")
        .join(spoke(assets, "asset_id", "infrastructure", both[:1]), "location_id", "left")
    )


def one_per_key(spoke: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """The row with the lowest id of each key, so that a join on the keys cannot multiply rows."""
    rest = [c for c in spoke.columns if c not in keys]
    return spoke.groupBy(*keys).agg(F.min_by(F.struct(*rest), id_col).alias("_r")).select(*keys, "_r.*")


def fire_events_full(events: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows with each dimension by its foreign key: ``dims`` maps key column to table."""
    out = events
    for key, dim in dims.items():
        out = out.join(dim, key, "left")
    return out


def link_fire_to_weather(events: DataFrame, weather: DataFrame) -> DataFrame:
    """Fill NULL ``weather_id`` with the nearest reading of the same calendar day.

    Distance is Euclidean in degrees; ties take the lowest weather_id; a day without
    readings leaves NULL. Events already linked keep their link.
    """
    day = F.to_date
    todo = events.where(F.col("weather_id").isNull()).withColumn("_day", day("event_date"))
    candidates = weather.select(day("datetime_record").alias("_day"), "latitude", "longitude", "weather_id")
    found = nearest.nearest_join(
        todo, candidates, ("latitude", "longitude"), ("latitude", "longitude"), "weather_id",
        by=["_day"], out=("_wid", "_d"),
    ).drop("rank", "_d")
    linked = events.withColumn("_day", day("event_date")).join(found, ["_day", "latitude", "longitude"], "left")
    return linked.withColumn("weather_id", F.coalesce("weather_id", "_wid")).select(*events.columns)


def nearest_grid_point(facilities: DataFrame, registry: DataFrame, limit_m: float = 1000.0) -> DataFrame:
    """Nearest registry row by great-circle metres with a match status per facility."""
    found = nearest.nearest_join(
        facilities, registry, ("latitude", "longitude"), ("grid_latitude", "grid_longitude"), "location_id",
        metric=nearest.HAVERSINE_M, out=("location_id", "_m"),
    )
    joined = nearest.attach_nearest(facilities, found, ["latitude", "longitude"])
    status = (
        F.when(F.col("_m").isNull(), "no_facility_lat_lon")
        .when(F.col("_m") <= limit_m, "matched").otherwise("matched_far_check_needed")
    )
    return joined.select(
        *facilities.columns, "location_id", F.round("_m", 2).alias("distance_to_grid_m"),
        status.alias("location_match_status"),
    )


def match_summary(matched: DataFrame, status: str = "location_match_status") -> DataFrame:
    return matched.groupBy(status).agg(F.count(F.lit(1)).alias("rows"))


def nearest_grid_degrees(points: DataFrame, cells: DataFrame, point_latlon, cell_latlon, cell_id: str, copy: list[str]) -> DataFrame:
    """Nearest grid row in degrees, copying some of its columns (e.g. the postcode)."""
    found = nearest.nearest_join(points, cells, point_latlon, cell_latlon, cell_id, out=(cell_id, "distance_deg"))
    with_copy = found.join(cells.select(cell_id, *copy), cell_id) if copy else found
    return nearest.attach_nearest(points, with_copy, list(point_latlon))


def incident_locations(incidents: DataFrame, registry: DataFrame, max_km: float = 20.0) -> DataFrame:
    """Incidents with the registry id of the windowed nearest search, NULL where none qualifies."""
    found = nearest.nearest_registry_windowed(incidents, registry, ("latitude", "longitude"), max_km)
    return nearest.attach_nearest(incidents, found, ["latitude", "longitude"])


def semi_by_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_semi")


def merge_layers(layers: list[DataFrame], key: str = "location_id") -> DataFrame:
    out = layers[0]
    for layer in layers[1:]:
        out = out.join(layer, key)
    return out


def label_spine_left(env: DataFrame, fires: DataFrame, keys: list[str], label: str = "is_burning") -> DataFrame:
    """Every environment row with its label, 0 where no fire was seen."""
    burning = fires.groupBy(*keys).agg(F.max(label).alias(label))
    return env.join(burning, keys, "left").withColumn(label, F.coalesce(F.col(label), F.lit(0)).cast("int"))


# State and country words ending a geocoder query.
QUERY_SUFFIXES = ["VIC, Australia", "Victoria, Australia"]


def address_queries(name: Column, address: Column, suburb: Column, lga: Column) -> Column:
    """Query texts in the order they are tried; a missing part counts as empty text."""
    n, a, s, g = (F.coalesce(c, F.lit("")) for c in (name, address, suburb, lga))
    short, long = (F.lit(x) for x in QUERY_SUFFIXES)

    def text(*parts: Column) -> Column:
        return F.concat_ws(", ", *parts)

    return F.array(text(a, s, short), text(a, s, long), text(n, s, short), text(a, s, g, long))


def geocode_from_cache(facilities: DataFrame, cache: DataFrame, source: str) -> DataFrame:
    """Resolve addresses against cached lookups: the first query with a hit wins.

    ``cache``: query, latitude, longitude, display_name (NULL coordinates = known miss).
    Facilities already matched pass through.
    """
    done = (
        F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
        & (F.coalesce(F.col("geocode_status"), F.lit("")) == "matched")
    )
    queries = address_queries(F.col("facility_name"), F.col("facility_address"), F.col("suburb"), F.col("lga"))
    tried = facilities.where(~done).select("_id", F.posexplode(queries).alias("pos", "query"))
    hits = cache.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        "query", F.struct("latitude", "longitude", "display_name", "query").alias("hit")
    )
    first = tried.join(hits, "query").groupBy("_id").agg(F.min_by("hit", "pos").alias("hit"))
    old = [c for c in facilities.columns if c not in (
        "latitude", "longitude", "geocode_status", "geocode_source", "geocode_query", "geocode_display_name")]
    joined = facilities.withColumn("_done", done).withColumn("_q", queries).join(first, "_id", "left")

    def pick(new: Column, kept: str) -> Column:
        return F.when(F.col("_done"), F.col(kept)).otherwise(new).alias(kept)

    return joined.select(
        *old, pick(F.col("hit.latitude"), "latitude"), pick(F.col("hit.longitude"), "longitude"),
        pick(F.when(F.col("hit").isNotNull(), "matched").otherwise("not_matched"), "geocode_status"),
        pick(F.lit(source), "geocode_source"),
        pick(F.coalesce(F.col("hit.query"), F.get("_q", F.lit(0))), "geocode_query"),
        pick(F.col("hit.display_name"), "geocode_display_name"),
    )


def geocode_summary(df: DataFrame) -> DataFrame:
    matched = F.count_if(F.col("geocode_status") == "matched")
    missed = F.count_if(F.col("geocode_status") == "not_matched")
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total"), (matched + missed).alias("processed"), matched.alias("matched"),
        missed.alias("not_matched"), (total - matched - missed).alias("remaining"),
        (total == matched + missed).alias("complete"),
    )


def feature_forecast_join(features: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Original features with their forecast by id, by position where the id is unknown.

    Both sides carry ``position``; a feature with neither raises, and so does an id or
    position that two forecasts share. The joined rows are stored once and checked there.
    """
    def single(key: str, name: str) -> DataFrame:
        known = forecasts.where(F.col(key).isNotNull()).groupBy(key)
        return known.agg(F.struct(F.first("forecast").alias("v"), F.count(F.lit(1)).alias("n")).alias(name))

    fallback_id = F.coalesce("id", F.col("position").cast("string"))
    joined = durable(
        features.withColumn("id", fallback_id).join(single("id", "_by_id"), "id", "left").join(single("position", "_by_pos"), "position", "left")
        .withColumn("forecast", F.coalesce("_by_id.v", "_by_pos.v"))
        .withColumn("_shared", F.when(F.col("_by_id.v").isNotNull(), F.col("_by_id.n")).otherwise(F.col("_by_pos.n")) > 1)
    )
    missing, several = joined.agg(F.count_if(F.col("forecast").isNull()), F.count_if("_shared")).first()
    if missing or several:
        raise QualityError(f"{missing} features without a forecast, {several} with more than one")
    return joined.drop("_by_id", "_by_pos", "_shared")


def suburb_reference(suburbs: DataFrame, registry: DataFrame) -> DataFrame:
    """Suburbs with numeric coordinates, blank rating as NULL, and the nearest registry id."""
    typed = suburbs.withColumns({
        "rating": F.nullif(F.trim("rating"), F.lit("")),
        "latitude": F.col("latitude").try_cast("double"),
        "longitude": F.col("longitude").try_cast("double"),
    }).dropna(subset=["latitude", "longitude"])
    found = nearest.nearest_join(
        typed, registry, ("latitude", "longitude"), ("grid_latitude", "grid_longitude"), "location_id",
        metric=nearest.HAVERSINE_KM, out=("location_id", "distance_km"),
    )
    return nearest.attach_nearest(typed, found, ["latitude", "longitude"])
