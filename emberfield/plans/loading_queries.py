"""Readers, load rules and streams, run on files that Spark derives from the tables.

Each query writes below a fresh folder of the shared directory and reads the result back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from emberfield import schemas
from emberfield.functions import geometry, grid, time
from emberfield.operators import hubs, ordering
from emberfield.plans.bindings import Tables
from emberfield.plans.registry import query, r6, rounded
from emberfield.session import scratch_path
from emberfield.sources import readers, sinks
from emberfield.streaming import streams

# -- readers ----------------------------------------------------------------


def _archive_rows(t: Tables):
    return t.hot.select(
        F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), "brightness", F.lit(0.4).alias("scan"), F.lit(0.4).alias("track"),
        "acq_date", "acq_time", "satellite", F.lit("VIIRS").alias("instrument"), F.col("band").alias("confidence"), F.lit("2.0").alias("version"),
        "bright_t31", "frp", "daynight", "k")


@query("read_csv_typed", "SELECT satellite, acq_time, acq_date, round(sum(frp),4) AS frp, count(bright_t31) AS known FROM hot GROUP BY 1,2,3", "hot")
def read_csv_typed(t: Tables):
    path = scratch_path(t.spark, "csv")
    sinks.write_csv(_archive_rows(t).drop("k"), path)
    back = readers.read_csv_typed(t.spark, path, schemas.ARCHIVE)
    absent = readers.read_csv_typed(t.spark, path + "-absent", schemas.ARCHIVE)
    return back.unionByName(absent).groupBy("satellite", "acq_time", "acq_date").agg(
        F.round(F.sum("frp"), 4).alias("frp"), F.count("bright_t31").alias("known"))


@query("read_firms_multi", """
SELECT CASE WHEN satellite = 'click' THEN 'modis' ELSE 'viirs' END AS source_product, count(*) AS n, count(CASE WHEN satellite <> 'click' THEN brightness END) AS with_ti4,
 2::BIGINT AS sources_read FROM hot GROUP BY 1""", "hot")
def read_firms_multi(t: Tables):
    base = scratch_path(t.spark, "firms")
    rows = _archive_rows(t).drop("k", "bright_t31")
    sinks.write_csv(rows.where("satellite <> 'click'").withColumnRenamed("brightness", "bright_ti4"), base + "/viirs")
    sinks.write_csv(rows.where("satellite = 'click'").drop("brightness"), base + "/modis")
    df, _, read = readers.read_firms_multi(t.spark, {"viirs": base + "/viirs", "modis": base + "/modis", "lost": base + "/lost"})
    return df.groupBy("source_product").agg(F.count(F.lit(1)).alias("n"), F.count("bright_ti4").alias("with_ti4")).withColumn(
        "sources_read", F.lit(len(read)).cast("bigint"))


@query("read_combined_satellites", """
SELECT satellite, CASE WHEN satellite = 'click' THEN CASE WHEN k <= 30 THEN 'l' WHEN k >= 70 THEN 'h' ELSE 'n' END ELSE band END AS confidence, count(*) AS n
FROM hot GROUP BY 1,2""", "hot")
def read_combined_satellites(t: Tables):
    base = scratch_path(t.spark, "combined")
    rows = _archive_rows(t)
    kinds = {"view": ["view", "purchase"], "signup": ["signup", "error"]}
    for name, satellites in kinds.items():
        sinks.write_csv(rows.where(F.col("satellite").isin(satellites)).drop("k"), f"{base}/{name}")
    modis = rows.where("satellite = 'click'").withColumn("confidence", F.col("k").cast("string")).drop("k")
    sinks.write_csv(modis, f"{base}/click")
    out = readers.read_combined_satellites(t.spark, f"{base}/view", f"{base}/signup", f"{base}/click")
    return out.groupBy("satellite", "confidence").agg(F.count(F.lit(1)).alias("n"))


@query("read_firms_daily", "SELECT acq_date, satellite, count(*) AS n FROM hot GROUP BY 1,2", "hot")
def read_firms_daily(t: Tables):
    """One file for every day there is, each year read whole; days without a file are passed over."""
    base = scratch_path(t.spark, "daily")
    rows = _archive_rows(t).drop("k")
    days = [r[0] for r in rows.select("acq_date").distinct().collect()]  # one per day of the archive
    for day in days:
        sinks.write_csv(rows.where(F.col("acq_date") == F.lit(day)), f"{base}/{day.year}/{day.timetuple().tm_yday:03d}.csv")
    years = [readers.read_firms_daily(t.spark, base, year, 1, 366) for year in sorted({d.year for d in days})]
    return hubs.union_all(years).groupBy("acq_date", "satellite").agg(F.count(F.lit(1)).alias("n"))


@query("read_year_chunks", "SELECT year(o_orderdate)::INT AS year, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM orders GROUP BY 1")
def read_year_chunks(t: Tables):
    """One unpacked archive per year in several chunks, and one full-year file beside a partial one."""
    base = scratch_path(t.spark, "years")
    schema, out = "o_orderkey BIGINT", None
    first, last = t.table("orders").agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    for year in range(first, last + 1):
        mine = t.table("orders").where(F.year("o_orderdate") == year).select("o_orderkey")
        for part in range(2):
            sinks.write_csv(mine.where(F.col("o_orderkey") % 2 == part), f"{base}/{year}/chunk{part}.csv")
        chunks = readers.read_year_chunks(t.spark, f"{base}/{year}", schema)
        out = chunks.withColumn("year", F.lit(year)) if out is None else out.unionByName(chunks.withColumn("year", F.lit(year)))
    return out.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@query("read_year_file", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE year(o_orderdate) = 1995 GROUP BY 1")
def read_year_file(t: Tables):
    base = scratch_path(t.spark, "year-file")
    rows = t.table("orders").where(F.year("o_orderdate") == 1995).select("o_orderpriority")
    for name in ("env_1995", "jan_1995", "era5land_1995"):
        sinks.write_csv(rows, f"{base}/{name}.csv")
    return readers.read_year_file(t.spark, base, 1995, "o_orderpriority STRING").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("read_env_exports", """
SELECT l_suppkey::VARCHAR AS grid_id, l_shipdate AS datetime FROM lineitem WHERE l_shipdate <= TIMESTAMP '2000-07-31' AND l_linenumber <> 3 GROUP BY 1,2""")
def read_env_exports(t: Tables):
    li = t.table("lineitem")
    exports = li.select(
        F.col("l_orderkey").cast("string").alias("system:index"), F.col("l_shipdate").alias("datetime"), F.col("l_suppkey").cast("string").alias("grid_id"),
        F.lit("").alias("interval_start"), *[F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias(f) for f in schemas.ENV_FEATURES], F.lit("{}").alias(".geo"))
    path = scratch_path(t.spark, "env")
    sinks.write_csv(exports, path)
    return readers.read_env_exports(t.spark, [path], "2000-07-31").select("grid_id", "datetime")


@query("read_fire_labels", """
SELECT acq_date::TIMESTAMP + to_hours(CASE WHEN daynight = 'D' THEN 0 ELSE 12 END) AS datetime, count(*) AS n FROM hot GROUP BY 1""", "hot")
def read_fire_labels(t: Tables):
    path = scratch_path(t.spark, "labels")
    labels = t.hot.select(F.col("acq_date").cast(time.NTZ).alias("datetime"), F.when(F.col("daynight") == "D", 0).otherwise(1).alias("daynight"),
                          F.lit(1).alias("is_burning"), F.lit("POINT (0 0)").alias("geometry"))
    sinks.write_csv(labels, path)
    return readers.read_fire_labels(t.spark, path).groupBy("datetime").agg(F.count(F.lit(1)).alias("n"))


@query("read_wkt_table", "SELECT fire_id, 5 AS points, round(lon-half,6) AS west, round(lat-half,6) AS south FROM fires", "fires")
def read_wkt_table(t: Tables):
    path = scratch_path(t.spark, "wkt")
    sinks.write_csv(t.fire_shapes.select("fire_id", geometry.to_wkt(F.col("rings")).alias("geometry")), path)
    back = readers.read_wkt_table(t.spark, path, "fire_id BIGINT, geometry STRING")
    b = geometry.bounds(F.col("rings"))
    return back.select("fire_id", F.size(F.flatten("rings")).alias("points"), r6(b["x0"]).alias("west"), r6(b["y0"]).alias("south"))


def _incident_payload(t: Tables):
    """One feature collection per detection; every fifth geometry is a collection, every seventh has no point."""
    i, k = F.col("event_id"), F.col("k")
    at = F.concat(F.lit("["), F.col("lon").cast("string"), F.lit(","), F.col("lat").cast("string"), F.lit("]"))
    point = F.concat(F.lit('{"type":"Point","coordinates":'), at, F.lit("}"))
    geom = F.when(i % 7 == 0, F.lit('{"type":"GeometryCollection","geometries":[]}')).when(i % 5 == 0, F.concat(
        F.lit('{"type":"GeometryCollection","geometries":[{"type":"Polygon","coordinates":[]},'), point, F.lit("]}"))).otherwise(point)
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("7Z"))
    props = F.struct(
        i.cast("string").alias("id"), F.when(k % 4 == 0, "Incident").when(k % 4 == 1, "incident").otherwise("warning").alias("feedType"),
        F.when(k % 5 == 0, "Fire").when(k % 5 == 2, "Bushfire").otherwise("Flooding").alias("category1"), F.lit("Other").alias("category2"),
        F.lit("Going").alias("status"), stamp.alias("created"), stamp.alias("updated"))
    return t.hot.select(i.alias("event_id"), F.concat(
        F.lit('{"type":"FeatureCollection","features":[{"type":"Feature","geometry":'), geom, F.lit(',"properties":'), F.to_json(props), F.lit("}]}")).alias("value"))


_INC = """
, f AS (SELECT event_id::VARCHAR AS id, ts, k, CASE WHEN event_id % 7 <> 0 THEN lat END AS latitude, CASE WHEN event_id % 7 <> 0 THEN lon END AS longitude FROM hot)"""


@query("read_geojson_features", _INC + "SELECT id, ts AS created, round(latitude,6) AS latitude, round(longitude,6) AS longitude FROM f", "hot")
def read_geojson_features(t: Tables):
    path = scratch_path(t.spark, "geojson")
    _incident_payload(t).select("value").write.text(path)
    rows = readers.read_geojson_features(t.spark, path, lines=True)
    return rounded(rows.withColumn("created", F.col("created").cast(time.NTZ)), "latitude", "longitude").select("id", "created", "latitude", "longitude")


@query("read_ascii_table", "SELECT c_mktsegment AS segment, count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM customer GROUP BY 1")
def read_ascii_table(t: Tables):
    path = scratch_path(t.spark, "ascii")
    line = F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit("    "), F.col("c_custkey").cast("string"))
    t.table("customer").select(line.alias("value")).write.text(path)
    rows = readers.read_ascii_table(t.spark, path, ["SEG", "KEY"])
    return rows.groupBy(F.col("SEG").alias("segment")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("KEY").cast("bigint")).alias("keys"))


@query("read_json_records", "SELECT c_custkey, c_name FROM customer")
def read_json_records(t: Tables):
    path = scratch_path(t.spark, "json")
    sinks.write_json(t.table("customer").select("c_custkey", "c_name"), path)
    return readers.read_json_records(t.spark, path, "c_custkey BIGINT, c_name STRING", lines=True)


def _hourly(t: Tables):
    """A three-hour payload per detection: readings k, k+1, k+2."""
    k, h = F.col("k").cast("double"), time.floor_hour(F.col("ts"))
    stamps = F.transform(F.array(*[F.lit(i) for i in range(3)]), lambda i: F.date_format(h + F.make_dt_interval(F.lit(0), i), "yyyy-MM-dd'T'HH:mm"))
    return t.hot.select("event_id", "ts", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), F.struct(
        stamps.alias("time"), F.array(k, k + 1, k + 2).alias("temperature_2m"), F.array(k, k, k).alias("relative_humidity_2m"),
        F.array(k, k - 1, k - 2).alias("wind_speed_10m")).alias("hourly"))


_HOURS = ", u AS (SELECT event_id, round(lat,6) AS latitude, round(lon,6) AS longitude, date_trunc('hour', ts) + to_hours(i::INT) AS time, (k+i)::DOUBLE AS temperature_2m, (k-i)::DOUBLE AS wind_speed_10m FROM hot, range(0,3) r(i))"


@query("unpivot_hourly_payload", _HOURS + "SELECT latitude, longitude, \"time\", temperature_2m, wind_speed_10m FROM u", "hot")
def unpivot_hourly_payload(t: Tables):
    out = readers.unpivot_hourly_payload(_hourly(t), ["temperature_2m", "wind_speed_10m"])
    return rounded(out, "latitude", "longitude")


@query("nearest_hour_slice", _HOURS + """
, l AS (SELECT latitude, longitude, "time", min(temperature_2m) AS temperature_2m FROM u GROUP BY 1,2,3),
r AS (SELECT *, row_number() OVER (PARTITION BY latitude, longitude ORDER BY abs(epoch("time" - TIMESTAMP '2024-01-15 12:20:00')), "time") AS rn FROM l)
SELECT latitude, longitude, "time", temperature_2m FROM r WHERE rn = 1""", "hot")
def nearest_hour_slice(t: Tables):
    rows = rounded(readers.unpivot_hourly_payload(_hourly(t), ["temperature_2m"]), "latitude", "longitude")
    one = rows.groupBy("latitude", "longitude", "time").agg(F.min("temperature_2m").alias("temperature_2m"))
    return readers.nearest_hour_slice(one, ["latitude", "longitude"], "time", F.lit("2024-01-15 12:20:00").cast(time.NTZ), ["temperature_2m"])


@query("flatten_grid_arrays", """
, c AS (SELECT event_id, i, lat + i*0.5 AS latitude, CASE WHEN k - 20*i >= 0 THEN (k - 20*i)::DOUBLE END AS sm, ts FROM hot, range(0,3) r(i))
SELECT event_id, round(latitude,6) AS latitude, sm AS sm_surface, CASE WHEN event_id % 4 <> 0 THEN date_trunc('second', ts) END AS timestamp FROM c WHERE sm IS NOT NULL AND latitude <= -37""", "hot")
def flatten_grid_arrays(t: Tables):
    i, k = F.col("event_id"), F.col("k").cast("double")
    stamp = F.when(i % 4 != 0, F.date_format("ts", "yyyyMMdd'T'HHmmss")).otherwise("bad")
    name = F.concat(F.lit("S_L4_SM_gph_"), stamp, F.lit("_Vv8010_"), i.cast("string"), F.lit(".h5"))
    src = t.hot.select(name.alias("file"), F.array(F.col("lat"), F.col("lat") + 0.5, F.col("lat") + 1.0).alias("cell_lat"),
                       F.array("lon", "lon", "lon").alias("cell_lon"), F.array(k, k - 20, k - 40).alias("sm_surface"))
    out = readers.flatten_grid_arrays(src, "cell_lat", "cell_lon", ["sm_surface"], F.col("file"), grid.Box(-44.0, -37.0, 112.0, 154.0))
    return out.select(F.regexp_extract("source_file", r"_(\d+)\.h5$", 1).cast("bigint").alias("event_id"), r6("latitude").alias("latitude"), "sm_surface", "timestamp")


@query("load_label_table", "SELECT text, toxic AS label FROM documents JOIN labels USING (doc_id)")
def load_label_table(t: Tables):
    src = t.table("documents").join(t.table("labels"), "doc_id").select("text", F.col("toxic").cast("string").alias("toxic"))
    return readers.load_label_table(src, "text", "toxic", [0, 1])


@query("point_time_series", """
SELECT epoch_ms(acq_date::TIMESTAMP) AS "time", acq_date::TIMESTAMP AS datetime, round(avg(frp),6) AS frp FROM hot
WHERE lat BETWEEN -37.8 - 1.0/111.32*50 AND -37.8 + 1.0/111.32*50 AND lon BETWEEN 145.0 - 50/111.32/cos(radians(-37.8)) AND 145.0 + 50/111.32/cos(radians(-37.8)) GROUP BY 1,2""", "hot")
def point_time_series(t: Tables):
    src = t.hot.withColumn("ms", F.unix_millis(F.col("acq_date").cast("timestamp")))
    out = readers.point_time_series(src, -37.8, 145.0, 10000.0, "ms", ["frp"], ("lat", "lon"))
    return rounded(out, "frp").select("time", "datetime", "frp")


@query("raw_region_values", """
SELECT ts, lat, lon, frp FROM hot WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' AND lat BETWEEN -39 AND -36 AND lon BETWEEN 143 AND 147""", "hot")
def raw_region_values(t: Tables):
    return readers.raw_region_values(t.hot, grid.Box(-39, -36, 143, 147), ["frp"], "ts", "2024-01-05", "2024-01-20", ("lat", "lon"))


@query("env_band_subset", """
, b AS (SELECT min(grid_latitude) AS s, max(grid_latitude) AS n, min(grid_longitude) AS w, max(grid_longitude) AS e FROM registry WHERE region_name = 'BUILDING')
SELECT ts, lat, lon, frp, brightness FROM hot, b WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' AND lat BETWEEN s AND n AND lon BETWEEN w AND e""", "hot registry")
def env_band_subset(t: Tables):
    region = t.registry.where("region_name = 'BUILDING'").agg(
        F.min("grid_latitude").alias("south"), F.max("grid_latitude").alias("north"), F.min("grid_longitude").alias("west"), F.max("grid_longitude").alias("east"))
    return readers.env_band_subset(t.hot, region, ["frp", "brightness"], "ts", "2024-01-05", "2024-01-20", ("lat", "lon"))


@query("typed_projection", "SELECT event_id, round(lat,6) AS latitude, date_trunc('minute', ts) AS acq_datetime FROM hot", "hot")
def typed_projection(t: Tables):
    src = t.hot.select("event_id", F.col("lat").cast("string").alias("latitude"), F.col("lon").cast("string").alias("longitude"),
                       F.col("acq_date").cast("string").alias("acq_date"), F.col("acq_time").cast("int").alias("acq_time"))
    return rounded(readers.typed_hotspots(src), "latitude").select("event_id", "latitude", "acq_datetime")


# -- load rules -------------------------------------------------------------

_KEY5 = "SELECT DISTINCT cell_x, cell_y, acq_date, daynight, satellite FROM hot"


@query("append_new_by_key", f", d AS ({_KEY5}) SELECT satellite, count(*) AS n, (SELECT count(*) FROM hot) - (SELECT count(*) FROM d) AS skipped FROM d GROUP BY 1", "hot")
def append_new_by_key(t: Tables):
    """The same batch loaded twice: the second load inserts nothing."""
    path = scratch_path(t.spark, "append")
    keys = ["cell_x", "cell_y", "acq_date", "daynight", "satellite"]
    batch = t.hot.select(*keys, "event_id")
    first = sinks.append_new_by_key(batch, path, keys, ["event_id"])
    again = sinks.append_new_by_key(batch, path, keys, ["event_id"])
    table = t.spark.read.parquet(path)
    return table.groupBy("satellite").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "skipped", F.lit(first["skipped"] + again["inserted"]).cast("bigint"))


def _regions(t: Tables):
    target = t.registry.select("location_id", F.round("grid_latitude", 1).alias("grid_latitude"), F.round("grid_longitude", 1).alias("grid_longitude"), "region_name")
    known = target.groupBy("grid_latitude", "grid_longitude").agg(F.min("location_id").alias("location_id"), F.min("region_name").alias("region_name"))
    region = F.when(F.col("event_id") % 4 > 0, F.col("satellite"))
    batch = t.hot.select(F.round("lat", 1).alias("grid_latitude"), F.round("lon", 1).alias("grid_longitude"), region.alias("region_name"), "event_id")
    return known.select("location_id", "grid_latitude", "grid_longitude", "region_name"), batch


def _upserted(t: Tables):
    return sinks.upsert_location(*_regions(t), "event_id")


_UPSERTED = """
, k AS (SELECT round(grid_latitude,1) AS la, round(grid_longitude,1) AS lo, min(location_id) AS location_id, min(region_name) AS r FROM registry GROUP BY 1,2),
b AS (SELECT round(lat,1) AS la, round(lon,1) AS lo, arg_max(event_id, event_id) AS e, arg_max({'s': CASE WHEN event_id % 4 > 0 THEN satellite END}, event_id).s AS r FROM hot GROUP BY 1,2)
SELECT coalesce(k.la,b.la) AS grid_latitude, coalesce(k.lo,b.lo) AS grid_longitude, location_id, CASE WHEN e IS NOT NULL THEN b.r ELSE k.r END AS region_name FROM k FULL JOIN b ON k.la = b.la AND k.lo = b.lo"""


@query("upsert_location", _UPSERTED, "hot registry")
def upsert_location(t: Tables):
    """The last value wins, also where it is NULL."""
    return _upserted(t)


@query("upsert_table", _UPSERTED, "hot registry")
def upsert_table(t: Tables):
    """The same on a stored table in hash buckets, of which a load replaces those of its own keys."""
    known, batch = _regions(t)
    path, keys = scratch_path(t.spark, "regions"), ["grid_latitude", "grid_longitude"]
    sinks.store_in_buckets(known, path, keys)
    sinks.upsert_table(batch, path, known.schema, keys, "region_name", "event_id")
    return sinks.read_buckets(t.spark, path, known.schema).drop("bucket")


@query("upsert_time", """
, b AS (SELECT date_trunc('hour', ts) AS h, arg_max(satellite, event_id) AS s FROM hot WHERE event_id % 3 = 0 GROUP BY 1)
SELECT datetime_record, coalesce(b.s, season) AS season FROM tim LEFT JOIN b ON b.h = datetime_record""", "tim")
def upsert_time(t: Tables):
    """A batch of a third of the events: hours that only the others have keep their season."""
    times = t.hubs[1].select("datetime_record", "season")
    batch = t.hot.where("event_id % 3 = 0").select(time.floor_hour(F.col("ts")).alias("datetime_record"), F.col("satellite").alias("season"), "event_id")
    return sinks.upsert_time(times, batch, "event_id")


@query("insert_ignore_time", "SELECT count(DISTINCT date_trunc('hour', ts)) AS n, count(DISTINCT date_trunc('hour', ts)) AS distinct_n FROM hot", "hot")
def insert_ignore_time(t: Tables):
    path = scratch_path(t.spark, "times")
    hours = t.hot.select(time.floor_hour(F.col("ts")).alias("datetime_record"))
    sinks.insert_ignore_time(hours, path)
    sinks.insert_ignore_time(hours, path)
    return t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("datetime_record").alias("distinct_n"))


@query("truncate_and_load", "SELECT user_id, count(*) AS n FROM hot GROUP BY 1", "hot")
def truncate_and_load(t: Tables):
    path = scratch_path(t.spark, "truncate")
    sinks.append(t.hot.select("user_id", "event_id"), path)
    sinks.truncate_and_load(t.hot.select("user_id", "event_id"), path)
    return t.spark.read.parquet(path).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("replace_then_append", "SELECT user_id, 2*count(*) AS n FROM hot GROUP BY 1", "hot")
def replace_then_append(t: Tables):
    path = scratch_path(t.spark, "replace")
    rows = t.hot.select("user_id", "event_id")
    sinks.replace_table(rows, path)
    sinks.append(rows, path)
    return t.spark.read.parquet(path).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("sort_for_export", """
SELECT row_number() OVER (ORDER BY ignition_date, fire_id) AS position, fire_id, ignition_date FROM fires""", "fires")
def sort_for_export(t: Tables):
    """Positions in the exported files, as written: file by file, line by line."""
    path = scratch_path(t.spark, "export")
    sinks.sort_for_export(t.fires.select("fire_id", "ignition_date"), "fires").write.parquet(path)
    back = t.spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return ordering.number_rows(back, ["_file", "_row"], "position").select("position", "fire_id", "ignition_date")


@query("project_to_target", "SELECT event_id, NULL::INTEGER AS weather_id, frp FROM hot", "hot")
def project_to_target(t: Tables):
    return sinks.project_to_target(t.hot, ["event_id", "weather_id", "frp"]).withColumn("weather_id", F.col("weather_id").cast("int"))


@query("run_log", "SELECT status, rows_fetched, rows_inserted, rows_skipped FROM (SELECT 'SUCCESS' AS status, count(*) AS rows_fetched, count(DISTINCT user_id) AS rows_inserted, "
       "count(*) - count(DISTINCT user_id) AS rows_skipped FROM hot UNION ALL SELECT 'PARTIAL', 0, 0, 0 UNION ALL SELECT 'FAILED', NULL, NULL, NULL)", "hot")
def run_log(t: Tables):
    path, table = scratch_path(t.spark, "log"), scratch_path(t.spark, "logged")
    ok, none, bad = (sinks.RunLog(t.spark, path, n) for n in ("ok", "none", "bad"))
    for run in (ok, none, bad):
        run.start(["a", "b"])
    ok.finish(["a"], sinks.append_new_by_key(t.hot.select("user_id", "event_id"), table, ["user_id"]))
    none.finish([], {"fetched": 0, "inserted": 0, "skipped": 0})
    bad.finish([], {}, "boom")
    states = sinks.run_states(t.spark.read.schema(schemas.RUN_LOG).parquet(path))
    return states.select("status", "rows_fetched", "rows_inserted", "rows_skipped")


@query("load_report", """
SELECT 'input' AS kind, 'fire' AS name, count(*) AS rows FROM hot UNION ALL SELECT 'output', 'fire', count(*) FROM hot_in
UNION ALL SELECT 'registry', 'location_ids', count(*) FROM loc UNION ALL SELECT 'registry', 'time_ids', count(*) FROM tim""", "loc tim")
def load_report(t: Tables):
    from emberfield.plans.join_queries import aligned

    loc, tim = t.hubs
    return sinks.load_report({"fire": t.hot}, {"fire": aligned(t)}, {"location_ids": loc, "time_ids": tim})


def _payloads(t: Tables):
    """A one-feature risk collection per detection; some are malformed or out of range."""
    i, k = F.col("event_id"), F.col("k")
    lon, lat = (k % 40).cast("string"), (k % 30).cast("string")
    coords = F.format_string("[[[%s,%s],[%s,%s],[%s,%s],[%s,%s]]]", lon, lat, lon, lat, lat, lon, lon, lat)
    good = F.format_string('{"type":"FeatureCollection","features":[{"type":"Feature","geometry":{"type":"Polygon","coordinates":%s},"properties":{"risk_factor":%d}}]}', coords, k % 5 + 1)
    text = F.when(i % 3 == 0, "null").when(i % 3 == 1, F.regexp_replace(good, '"risk_factor":.', '"risk_factor":9')).otherwise(good)
    return t.hot.select("event_id", "ts", text.alias("payload"))


_SNAP = "SELECT k % 5 + 1 AS risk_factor, (k % 40)::DOUBLE AS west FROM hot WHERE event_id = (SELECT max(event_id) FROM hot WHERE event_id % 3 = 2)"


@query("latest_snapshot", _SNAP, "hot")
def latest_snapshot(t: Tables):
    out = sinks.latest_snapshot(_payloads(t), "payload", ["event_id"])
    return out.select(F.col("risk_factor").cast("bigint").alias("risk_factor"), F.col("geometry.coordinates")[0][0][0].alias("west"))


@query("write_geojson", "SELECT fire_id, 'Feature' AS type, size_class FROM fires", "fires")
def write_geojson(t: Tables):
    path = scratch_path(t.spark, "features")
    sinks.write_geojson(t.fire_shapes.select("fire_id", "size_class", "rings"), "rings", path, path + "-csv")
    shape = "type STRING, geometry STRUCT<type: STRING, coordinates: ARRAY<ARRAY<ARRAY<DOUBLE>>>>, properties STRUCT<fire_id: BIGINT, size_class: STRING>"
    back = t.spark.read.schema(shape).json(path)
    return back.where(F.size(F.col("geometry.coordinates")[0]) == 5).select("properties.fire_id", "type", "properties.size_class")


@query("write_json", "SELECT event_id, bright_t31 FROM hot", "hot")
def write_json(t: Tables):
    path = scratch_path(t.spark, "write-json")
    sinks.write_json(t.hot.select("event_id", "bright_t31"), path)
    return t.spark.read.schema("event_id BIGINT, bright_t31 DOUBLE").json(path)


# -- streams ----------------------------------------------------------------

EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def _event_stream(t: Tables):
    return streams.file_stream(t.spark, t.folder, "parquet", EVENTS, "events.parquet")


@query("env_12h_stream", """
, w AS (SELECT event_type, time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '2000-01-01') AS s, avg(value) AS v FROM events GROUP BY 1,2)
SELECT event_type, s AS interval_start, s + INTERVAL 12 HOUR AS interval_end, round(v + 1e-9,6) AS value FROM w WHERE s + INTERVAL 12 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def env_12h_stream(t: Tables):
    """Three files in three batches, each holding rows of all days, so later ones bring late rows."""
    src, table, cp = (scratch_path(t.spark, n) for n in ("events-12h", "stream-12h", "cp-12h"))
    t.table("events").withColumn("part", F.col("event_id") % 3).repartition("part").write.partitionBy("part").parquet(src)
    stream = streams.file_stream(t.spark, src + "/part=*", "parquet", EVENTS, maxFilesPerTrigger=1)
    streams.env_12h_stream(stream, ["event_type"], "ts", ["value"], table, cp).awaitTermination()
    means = t.spark.read.parquet(table).drop("day")
    return rounded(means.withColumn("value", F.col("value") + 1e-9), "value")  # sums in another order must not flip a tie


@query("hotspot_stream", """
SELECT satellite, acq_date < DATE '2024-01-05' AS late, count(*) AS n FROM (SELECT DISTINCT round(lat,6), round(lon,6), acq_date, acq_time, satellite FROM hot) GROUP BY 1,2""", "hot")
def hotspot_stream(t: Tables):
    """Several files and batches against one reference time; older rows are in the late table."""
    src = scratch_path(t.spark, "hotspot-files")
    rows = _archive_rows(t).drop("k", "brightness", "bright_t31").withColumns({"latitude": F.round("latitude", 6), "longitude": F.round("longitude", 6)})
    sinks.write_csv(rows.repartition(3, "satellite"), src)
    table, late, log, cp = (scratch_path(t.spark, n) for n in ("hotspots", "late", "hotspot-log", "cp-hot"))
    schema = ", ".join(f"{c} STRING" for c in rows.columns)
    stream = streams.file_stream(t.spark, src, "csv", schema, header="true", maxFilesPerTrigger=1)
    streams.hotspot_stream(stream, table, late, log, cp, delay_days=10, reference=dt.datetime(2024, 1, 15)).awaitTermination()
    keys = ["satellite", "late"]
    both = t.spark.read.parquet(table).withColumn("late", F.lit(False)).select(*keys).unionByName(t.spark.read.parquet(late).withColumn("late", F.lit(True)).select(*keys))
    return both.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@query("incident_stream", _INC + """
, kept AS (SELECT * FROM f WHERE k % 4 IN (0,1) AND k % 5 IN (0,2))
SELECT count(*) AS n, count(DISTINCT id) AS ids, count(latitude) AS located FROM kept""", "hot")
def incident_stream(t: Tables):
    src = scratch_path(t.spark, "incident-files")
    _incident_payload(t).orderBy(F.desc("event_id")).select("value").coalesce(3).write.text(src)  # newest first
    table, cp = scratch_path(t.spark, "incidents"), scratch_path(t.spark, "cp-inc")
    stream = streams.file_stream(t.spark, src, "json", schemas.INCIDENT_FEATURES, maxFilesPerTrigger=1)
    streams.incident_stream(stream, t.registry, table, cp).awaitTermination()
    return t.spark.read.parquet(table).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"), F.count("latitude").alias("located"))


@query("refresh_on_change", "SELECT acq_date, count(*) AS n FROM hot WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY GROUP BY 1", "hot")
def refresh_on_change(t: Tables):
    from emberfield.operators.cleaning import recent_rows

    table, cp = scratch_path(t.spark, "extract"), scratch_path(t.spark, "cp-extract")

    def recompute(_spark):
        kept = recent_rows(t.hot, "ts", F.lit("2024-01-31").cast(time.NTZ), days=7)
        return kept.groupBy("acq_date").agg(F.count(F.lit(1)).alias("n"))

    streams.refresh_on_change(_event_stream(t), recompute, table, cp, "acq_date", F.to_date("ts")).awaitTermination()
    return t.spark.read.parquet(table).select("acq_date", "n")


@query("risk_snapshot_stream", _SNAP, "hot")
def risk_snapshot_stream(t: Tables):
    src = scratch_path(t.spark, "payloads")
    _payloads(t).write.parquet(src)
    table, cp = scratch_path(t.spark, "snapshot"), scratch_path(t.spark, "cp-snap")
    stream = streams.file_stream(t.spark, src, "parquet", "event_id BIGINT, ts TIMESTAMP_NTZ, payload STRING")
    streams.risk_snapshot_stream(stream, "payload", ["event_id"], table, cp).awaitTermination()
    out = t.spark.read.parquet(table)
    return out.select(F.col("risk_factor").cast("bigint").alias("risk_factor"), F.col("geometry.coordinates")[0][0][0].alias("west"))


@query("weather_current_stream", """
, u AS (SELECT DISTINCT round(lat,6) AS la, round(lon,6) AS lo, strftime(date_trunc('hour', ts) + to_hours(i::INT),'%Y%m%d%H')::BIGINT AS time_id, k, i FROM hot, range(0,3) r(i))
SELECT time_id, count(DISTINCT (la, lo)) AS n FROM u WHERE k - i >= 0 AND k + i <= 60 GROUP BY 1""", "hot")
def weather_current_stream(t: Tables):
    src = scratch_path(t.spark, "weather-files")
    payload = _hourly(t).select(F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"), "hourly")
    sinks.write_json(payload, src)
    table, cp = scratch_path(t.spark, "weather"), scratch_path(t.spark, "cp-weather")
    stream = streams.file_stream(t.spark, src, "json", schemas.HOURLY)
    streams.weather_current_stream(stream, table, cp).awaitTermination()
    return t.spark.read.parquet(table).groupBy("time_id").agg(F.count(F.lit(1)).alias("n"))


@query("number_rows", "SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS row_id FROM lineitem")
def number_rows(t: Tables):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    return ordering.number_rows(t.table("lineitem").select(*keys), keys).select("l_orderkey", "l_linenumber", "l_partkey", "row_id")


