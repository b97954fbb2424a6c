"""Cleaning and filter queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberfield.functions import grid, time
from emberfield.operators import cleaning, facilities
from emberfield.plans.bindings import Tables
from emberfield.plans.registry import query, r6

_ARCHIVE = """
, a AS (SELECT event_id, CASE WHEN event_id % 97 = 0 THEN 'acq_date' WHEN event_id % 89 = 0 THEN 'n/a' ELSE acq_date::VARCHAR END AS acq_date,
        lat, lon, CASE WHEN k % 10 = 0 THEN 'h' ELSE k::VARCHAR END AS confidence, k FROM hot)"""


def _archive(t: Tables):
    i, k = F.col("event_id"), F.col("k")
    return t.hot.select(
        "event_id", F.when(i % 97 == 0, "acq_date").when(i % 89 == 0, "n/a").otherwise(F.col("acq_date").cast("string")).alias("acq_date"),
        F.col("lat").cast("string").alias("latitude"), F.col("lon").cast("string").alias("longitude"),
        F.when(k % 10 == 0, "h").otherwise(k.cast("string")).alias("confidence"))


@query("clean_firms_history", _ARCHIVE + """
SELECT row_number() OVER (ORDER BY try_cast(acq_date AS DATE), event_id) AS event_id, round(lat,6) AS latitude, round(lon,6) AS longitude,
       try_cast(acq_date AS TIMESTAMP) AS event_date, k::DOUBLE AS confidence_score, 'NASA FIRMS' AS source_system
FROM a WHERE try_cast(acq_date AS DATE) BETWEEN '2024-01-05' AND '2024-01-25' AND try_cast(confidence AS DOUBLE) IS NOT NULL""", "hot")
def clean_firms_history(t: Tables):
    src = _archive(t).withColumnRenamed("event_id", "line")
    out = cleaning.clean_firms_history(src, ("2024-01-05", "2024-01-25"), order=["event_date", "line"])
    return out.select("event_id", r6("latitude").alias("latitude"), r6("longitude").alias("longitude"), "event_date",
                      "confidence_score", "source_system")


@query("clean_fire_events", """
SELECT latitude, longitude, acq_date AS event_date, coalesce(try_cast(conf AS DOUBLE), 0)::INT AS confidence_score, 'NASA FIRMS' AS source_system
FROM (SELECT DISTINCT cell_x AS latitude, cell_y AS longitude, acq_date,
      CASE WHEN k % 10 = 0 THEN 'h' || (k // 50)::VARCHAR ELSE k::VARCHAR END AS conf FROM hot WHERE bright_t31 IS NOT NULL)""", "hot")
def clean_fire_events(t: Tables):
    k = F.col("k")
    conf = F.when(k % 10 == 0, F.concat(F.lit("h"), F.floor(k / 50).cast("string"))).otherwise(k.cast("string"))
    src = t.hot.select(F.when(F.col("bright_t31").isNotNull(), F.col("cell_x")).alias("latitude"), F.col("cell_y").alias("longitude"),
                       F.col("acq_date").cast("string").alias("acq_date"), conf.alias("confidence"))
    return cleaning.clean_fire_events(src).drop(*cleaning.NULL_KEYS)


@query("clean_weather", """
SELECT DISTINCT cell_x AS location_id, acq_date, brightness::DOUBLE AS temperature, bright_t31 AS humidity, k::DOUBLE AS wind, satellite
FROM hot WHERE bright_t31 IS NOT NULL""", "hot")
def clean_weather(t: Tables):
    src = t.hot.select(F.col("cell_x").alias("location_id"), F.col("acq_date").cast("string").alias("acq_date"),
                       F.col("brightness").cast("string").alias("temperature"), F.col("bright_t31").alias("humidity"),
                       F.col("k").cast("string").alias("wind"), "satellite")
    return cleaning.clean_weather(src, {"location_id": "bigint", "acq_date": "date", "temperature": "double", "humidity": "double",
                                        "wind": "double", "satellite": "string"})


@query("clean_open_meteo", """
SELECT DISTINCT date_trunc('minute', ts) AS "time", bright_t31 AS temperature FROM hot WHERE bright_t31 IS NOT NULL""", "hot")
def clean_open_meteo(t: Tables):
    src = t.hot.select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"), F.col("bright_t31").alias("temperature"))
    return cleaning.clean_weather(src, {"time": "timestamp_ntz", "temperature": "double"})


@query("validate_weather", """
SELECT event_id, k * 1.2::DOUBLE - 10 AS relative_humidity, frp - 5 AS wind_speed_kmh, bright_t31 - 285 AS temperature_c FROM hot
WHERE bright_t31 IS NOT NULL AND k * 1.2::DOUBLE - 10 BETWEEN 0 AND 100 AND frp - 5 >= 0 AND bright_t31 - 285 BETWEEN -20 AND 60""", "hot")
def validate_weather(t: Tables):
    src = t.hot.select("event_id", F.col("cell_x").alias("location_id"), F.col("cell_y").alias("time_id"),
                       (F.col("k") * F.lit(1.2) - 10).alias("relative_humidity"), (F.col("frp") - 5).alias("wind_speed_kmh"),
                       (F.col("bright_t31") - 285).alias("temperature_c"))
    return cleaning.validate_weather(src).drop("location_id", "time_id")


@query("period_filter", """
SELECT fire_id, ignition_date, area_ha FROM fires WHERE ignition_date BETWEEN '1998-07-01' AND '2000-07-31' AND area_ha > 0""", "fires")
def period_filter(t: Tables):
    return cleaning.period_filter(t.fires, "ignition_date", "1998-07-01", "2000-07-31", "area_ha").select("fire_id", "ignition_date", "area_ha")


@query("state_bbox_filter", """
SELECT fire_id FROM fires WHERE lat BETWEEN -39.2 AND -33.98 AND lon BETWEEN 141.0 AND 150.0 AND fire_type = 'Bushfire'""", "fires")
def state_bbox_filter(t: Tables):
    return cleaning.state_bbox_filter(t.fires, "lat", "lon", "fire_type", grid.STATE_BOX, "Bushfire").select("fire_id")


@query("fire_type_filter", "SELECT season, count(*) AS n FROM fires WHERE fire_type = 'Bushfire' GROUP BY 1", "fires")
def fire_type_filter(t: Tables):
    return cleaning.fire_type_filter(t.fires).groupBy("season").agg(F.count(F.lit(1)).alias("n"))


@query("drop_columns", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def drop_columns(t: Tables):
    return t.table("orders").drop("o_orderstatus", "o_totalprice", "o_orderpriority")


def _feed(t: Tables):
    k, i = F.col("k"), F.col("event_id")
    return t.hot.select(
        F.when(i % 50 == 0, "").when(i % 51 == 0, F.lit(None)).otherwise(i.cast("string")).alias("id"), F.col("ts").alias("created"),
        F.when(k % 4 == 0, "INCIDENT").when(k % 4 == 1, "incident").when(k % 4 == 2, "warning").alias("feed_type"),
        F.when(k % 5 == 0, "Fire").when(k % 5 == 1, "Flooding").when(k % 5 == 2, "Bushfire").alias("category1"),
        F.when(k % 7 == 0, "Planned Burn").when(k % 7 == 1, "Other").alias("category2"))


@query("fire_incident_filter", """
SELECT event_id::VARCHAR AS id, ts AS created, row_number() OVER (ORDER BY ts DESC) AS newest FROM hot
WHERE event_id % 50 <> 0 AND event_id % 51 <> 0 AND k % 4 IN (0,1) AND (k % 5 IN (0,2) OR k % 7 = 0)""", "hot")
def fire_incident_filter(t: Tables):
    from emberfield.operators.ordering import number_rows

    kept = cleaning.fire_incident_filter(_feed(t)).select("id", "created")
    return number_rows(kept, [F.desc("created"), "id"], "newest")


@query("remove_missing_drop", "SELECT event_id, bright_t31 FROM hot WHERE bright_t31 IS NOT NULL", "hot")
def remove_missing_drop(t: Tables):
    return cleaning.remove_missing(t.hot.select("event_id", "bright_t31"), "drop", subset=["bright_t31"])


@query("remove_missing_fill", "SELECT event_id, coalesce(bright_t31, -999.0::DOUBLE) AS bright_t31 FROM hot", "hot")
def remove_missing_fill(t: Tables):
    return cleaning.remove_missing(t.hot.select("event_id", "bright_t31"), "fill", {"bright_t31": -999.0})


for _keep, _sql in (
    ("first", "SELECT user_id, acq_date, min(event_id) AS event_id FROM hot GROUP BY 1,2"),
    ("last", "SELECT user_id, acq_date, max(event_id) AS event_id FROM hot GROUP BY 1,2"),
    (False, "SELECT user_id, acq_date, min(event_id) AS event_id FROM hot GROUP BY 1,2 HAVING count(*) = 1"),
):
    @query(f"remove_duplicates_{_keep or 'none'}", _sql, "hot")
    def remove_duplicates(t: Tables, keep=_keep):
        src = t.hot.select("user_id", "acq_date", "event_id")
        return cleaning.remove_duplicates(src, ["user_id", "acq_date"], keep, ["event_id"])


@query("cast_types", "SELECT event_id, k, CASE WHEN k % 10 = 0 THEN 'h' ELSE k::VARCHAR END AS mixed, frp FROM hot", "hot")
def cast_types(t: Tables):
    k = F.col("k")
    src = t.hot.select("event_id", k.cast("string").alias("k"), F.when(k % 10 == 0, "h").otherwise(k.cast("string")).alias("mixed"),
                       F.col("frp").cast("string").alias("frp"))
    return cleaning.cast_types(src, {"k": "int", "mixed": "int", "frp": "float", "absent": "int"})[0]


@query("clean_report", """
, c AS (SELECT DISTINCT cell_x, cell_y, bright_t31 FROM hot WHERE bright_t31 IS NOT NULL)
SELECT cell_x, cell_y, bright_t31, (SELECT count(*) FROM hot) - (SELECT count(*) FROM c) AS rows_removed FROM c""", "hot")
def clean_report(t: Tables):
    src = t.hot.select(F.col("cell_x").cast("string").alias("cell_x"), F.col("cell_y").cast("string").alias("cell_y"), "bright_t31")
    out, report = cleaning.clean(src, {"cell_x": "int", "cell_y": "int"})
    first, last = (int(part.split(": ")[1].split(" ")[0]) for part in report.splitlines()[0].split(", ")[:2])
    removed = first - last
    return out.withColumn("rows_removed", F.lit(removed).cast("bigint"))


@query("dedupe_facilities", """
, u AS (SELECT 0 AS src, c_custkey AS line, 'Hall ' || (c_custkey % 400)::VARCHAR || CASE WHEN c_custkey % 2 = 0 THEN ' ' ELSE '' END AS n,
        'Road ' || (c_custkey % 40)::VARCHAR AS a, 'Town ' || (c_custkey % 20)::VARCHAR AS s, c_mktsegment || ' ' AS l FROM customer
        UNION ALL SELECT 1, s_suppkey, 'Hall ' || (s_suppkey % 400)::VARCHAR, 'Road ' || (s_suppkey % 40)::VARCHAR, 'Town ' || (s_suppkey % 20)::VARCHAR, s_name FROM supplier),
f AS (SELECT *, row_number() OVER (PARTITION BY n, a, s ORDER BY src, line) AS rn FROM u)
SELECT row_number() OVER (ORDER BY src, line) AS _id, trim(n) AS facility_name, a AS facility_address, s AS suburb, trim(l) AS lga
FROM f WHERE rn = 1""")
def dedupe_facilities(t: Tables):
    return facilities.dedupe_facilities(_registers(t), ["line"]).select("_id", "facility_name", "facility_address", "suburb", "lga")


@query("dedupe_facilities_trimmed", """
, u AS (SELECT 0 AS src, c_custkey AS line, 'Hall ' || (c_custkey % 400)::VARCHAR AS n, 'Road ' || (c_custkey % 40)::VARCHAR AS a, 'Town ' || (c_custkey % 20)::VARCHAR AS s, c_mktsegment AS l FROM customer
        UNION ALL SELECT 1, s_suppkey, 'Hall ' || (s_suppkey % 400)::VARCHAR, 'Road ' || (s_suppkey % 40)::VARCHAR, 'Town ' || (s_suppkey % 20)::VARCHAR, s_name FROM supplier),
f AS (SELECT *, row_number() OVER (PARTITION BY n, a, s ORDER BY src, line) AS rn FROM u)
SELECT row_number() OVER (ORDER BY src, line) AS _id, n AS facility_name, a AS facility_address, s AS suburb, l AS lga FROM f WHERE rn = 1""")
def dedupe_facilities_trimmed(t: Tables):
    """Copies that differ in blanks only are one facility."""
    return facilities.dedupe_facilities(_registers(t), ["line"], trim_first=True).select("_id", "facility_name", "facility_address", "suburb", "lga")


def _registers(t: Tables):
    def reg(df, k: str, extra, lga):
        key = F.col(k)
        return df.select(
            key.alias("_id"), key.alias("line"), F.concat(F.lit("Hall "), (key % 400).cast("string"), extra(key)).alias("facility_name"),
            F.concat(F.lit("Road "), (key % 40).cast("string")).alias("facility_address"),
            F.concat(F.lit("Town "), (key % 20).cast("string")).alias("suburb"), lga.alias("lga"))

    a = reg(t.table("customer"), "c_custkey", lambda k: F.when(k % 2 == 0, " ").otherwise(""), F.concat("c_mktsegment", F.lit(" ")))
    b = reg(t.table("supplier"), "s_suppkey", lambda k: F.lit(""), F.col("s_name"))
    return [a, b]


@query("env_coalesce_numeric", "SELECT event_id, k::DOUBLE AS k, bright_t31 FROM hot WHERE k % 10 <> 0 AND bright_t31 IS NOT NULL", "hot")
def env_coalesce_numeric(t: Tables):
    k = F.col("k")
    src = t.hot.select("event_id", F.when(k % 10 == 0, "h").otherwise(k.cast("string")).alias("k"), F.col("bright_t31").cast("string").alias("bright_t31"))
    return cleaning.env_coalesce_numeric(src, ["k", "bright_t31"])


@query("region_box", "SELECT event_id FROM hot WHERE lat BETWEEN -38.5 AND -37.0 AND lon BETWEEN 144.0 AND 146.0", "hot")
def region_box(t: Tables):
    return cleaning.region_box(t.hot, "lat", "lon", grid.Box(-38.5, -37.0, 144.0, 146.0)).select("event_id")


@query("recent_rows_days", "SELECT event_id, ts FROM hot WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY", "hot")
def recent_rows_days(t: Tables):
    return cleaning.recent_rows(t.hot, "ts", F.lit("2024-01-31").cast(time.NTZ), days=7).select("event_id", "ts")


@query("recent_rows_hours", "SELECT event_id, ts FROM hot WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 36 HOUR", "hot")
def recent_rows_hours(t: Tables):
    return cleaning.recent_rows(t.hot, "ts", F.lit("2024-01-31").cast(time.NTZ), hours=36).select("event_id", "ts")


@query("admin_boundary_filter", """
SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name = 'ASIA' AND n_name = 'NATION_12'""")
def admin_boundary_filter(t: Tables):
    c = t.table("customer").join(t.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return cleaning.admin_boundary_filter(c, "r_name", "n_name", ("ASIA", "NATION_12")).select("c_custkey", "n_name", "r_name")


@query("nan_to_null", "SELECT cell_x, max(bright_t31) AS top, count(bright_t31) AS known FROM hot GROUP BY 1", "hot")
def nan_to_null(t: Tables):
    nan = t.hot.select("cell_x", F.coalesce("bright_t31", F.lit(float("nan"))).alias("bright_t31"))
    return cleaning.nan_to_null(nan).groupBy("cell_x").agg(F.max("bright_t31").alias("top"), F.count("bright_t31").alias("known"))


@query("union_by_name", """
SELECT event_id, satellite, brightness, NULL::DOUBLE AS bright_ti4 FROM hot WHERE satellite = 'view'
UNION ALL SELECT event_id, satellite, NULL, brightness FROM hot WHERE satellite <> 'view'""", "hot")
def union_by_name(t: Tables):
    from emberfield.operators.hubs import union_all

    a = t.hot.where("satellite = 'view'").select("event_id", "satellite", "brightness")
    b = t.hot.where("satellite <> 'view'").select(F.col("brightness").alias("bright_ti4"), "satellite", "event_id")
    return union_all([a, b])


@query("distinct", "SELECT DISTINCT cell_x, cell_y, satellite FROM hot", "hot")
def distinct(t: Tables):
    return t.hot.select("cell_x", "cell_y", "satellite").distinct()
