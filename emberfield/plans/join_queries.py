"""Joins: hubs, nearest, polygons, facilities; and interpolation onto grids."""

from __future__ import annotations

from pyspark.sql import functions as F


from emberfield.operators import copies, environment, interpolation, polygons, relational
from emberfield.plans.bindings import Tables, diamond
from emberfield.plans.registry import query, r6, rounded
from emberfield.plans.sqlviews import equirect, euclid, haversine

ALIGNED = """
, fi AS (SELECT event_id AS incident_id, l.location_id, t.time_id, lat, lon, frp, satellite, datetime_record, season, l.lat_idx, l.lon_idx
         FROM hot_in JOIN loc l USING (lat_idx, lon_idx) JOIN tim t ON datetime_record = date_trunc('hour', ts))"""


def aligned(t: Tables):
    from emberfield.operators import hubs

    loc, tim = t.hubs
    obs = t.hot.select(F.col("event_id").alias("incident_id"), F.col("lat").alias("original_latitude"),
                       F.col("lon").alias("original_longitude"), F.col("ts").alias("datetime_record"), "frp", "satellite")
    return hubs.align_observation(obs, loc, tim, "incident_id", ["original_latitude", "original_longitude", "frp", "satellite"])


@query("incidents_with_hubs", ALIGNED + """
SELECT incident_id, location_id, time_id, lat AS original_latitude, lon AS original_longitude, frp, satellite,
       round(lat_idx*0.1::DOUBLE,6) AS grid_latitude, round(lon_idx*0.1::DOUBLE,6) AS grid_longitude, datetime_record, season FROM fi""", "loc tim")
def incidents_with_hubs(t: Tables):
    loc, tim = t.hubs
    return rounded(relational.incidents_with_hubs(aligned(t), loc, tim), "grid_latitude", "grid_longitude").drop("region_name")


_OBS_HUB = """
, w AS (SELECT cell % (SELECT count(*) FROM registry) + 1 AS location_id, ts, quantity, price, discount, tax FROM obs),
tr AS (SELECT row_number() OVER (ORDER BY ts) AS time_id, ts AS datetime_record FROM (SELECT DISTINCT ts FROM obs))"""


@query("risk_inputs", _OBS_HUB + """
SELECT w.location_id, time_id, datetime_record, round(grid_latitude,6) AS grid_latitude, round(grid_longitude,6) AS grid_longitude,
       grid_row, grid_col, region_name, quantity, price, discount, tax
FROM w JOIN registry USING (location_id) JOIN tr ON datetime_record = ts""", "obs registry")
def risk_inputs(t: Tables):
    from emberfield.operators.ordering import number_rows

    times = number_rows(t.obs.select(F.col("ts").alias("datetime_record")).distinct(), ["datetime_record"], "time_id")
    n = t.registry.agg(F.count(F.lit(1))).scalar()
    w = t.obs.withColumn("location_id", F.col("cell") % n + 1).join(
        times.withColumnRenamed("datetime_record", "ts"), "ts")
    out = relational.risk_inputs(w, t.registry, times, ["quantity", "price", "discount", "tax"])
    return rounded(out, "grid_latitude", "grid_longitude")


@query("fire_event_full_v2", ALIGNED + """
, we AS (SELECT min(incident_id) AS weather_id, location_id, time_id, arg_min(lat, incident_id) AS lat, arg_min(lon, incident_id) AS lon FROM fi WHERE incident_id % 3 = 0 GROUP BY location_id, time_id),
ve AS (SELECT min(incident_id) AS veg_condition_id, location_id, time_id FROM fi WHERE incident_id % 5 = 0 GROUP BY location_id, time_id),
tp AS (SELECT min(incident_id) AS topo_id, location_id FROM fi WHERE incident_id % 2 = 0 GROUP BY location_id),
ia AS (SELECT min(incident_id) AS asset_id, location_id, arg_min(lat, incident_id) AS lat FROM fi WHERE incident_id % 40 = 0 GROUP BY location_id)
SELECT incident_id, location_id, time_id, fi.lat AS fire_original_latitude, season, weather_id, veg_condition_id, topo_id, asset_id,
       we.lon AS weather_original_longitude, ia.lat AS infrastructure_original_latitude
FROM fi LEFT JOIN we USING (location_id, time_id) LEFT JOIN ve USING (location_id, time_id) LEFT JOIN tp USING (location_id)
LEFT JOIN ia USING (location_id)""", "loc tim")
def fire_event_full_v2(t: Tables):
    loc, tim = t.hubs
    fi = aligned(t)
    i = F.col("incident_id")

    def spoke(name: str, every: int, *keys: str):
        rows = fi.where(i % every == 0).select("location_id", "time_id", "original_latitude", "original_longitude", i.alias(name))
        return relational.one_per_key(rows, list(keys), name)

    both = ("location_id", "time_id")
    full = relational.fire_event_full(
        fi, loc, tim, spoke("weather_id", 3, *both), spoke("veg_condition_id", 5, *both), spoke("topo_id", 2, "location_id"), spoke("asset_id", 40, "location_id"))
    return full.select("incident_id", "location_id", "time_id", "fire_original_latitude", "season", "weather_id", "veg_condition_id",
                       "topo_id", "asset_id", "weather_original_longitude", "infrastructure_original_latitude")


@query("fire_events_full", """
SELECT l_orderkey, l_linenumber, l_quantity, o_orderdate, p_type, s_name
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey""")
def fire_events_full(t: Tables):
    fact = t.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    dims = {
        "l_orderkey": t.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"),
        "l_partkey": t.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_type"),
        "l_suppkey": t.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name"),
    }
    return relational.fire_events_full(fact, dims).drop("l_partkey", "l_suppkey")


@query("link_fire_to_weather", f"""
, fx AS (SELECT event_id, CASE WHEN event_id % 14 = 0 THEN acq_date + 400 ELSE acq_date END AS acq_date, lat, lon FROM hot WHERE event_id % 2 = 0),
wx AS (SELECT event_id AS weather_id, acq_date, lat, lon FROM hot WHERE event_id % 2 = 1),
rk AS (SELECT event_id, weather_id, row_number() OVER (PARTITION BY event_id ORDER BY {euclid('f.lat','f.lon','w.lat','w.lon')}, weather_id) AS rn
       FROM fx f JOIN wx w USING (acq_date))
SELECT event_id, CASE WHEN event_id % 10 = 0 THEN -1 ELSE weather_id END AS weather_id
FROM fx LEFT JOIN (SELECT * FROM rk WHERE rn = 1) USING (event_id)""", "hot")
def link_fire_to_weather(t: Tables):
    """All readings; some fires are dated outside their days and stay unlinked."""
    i = F.col("event_id")
    linked = F.when(i % 10 == 0, F.lit(-1)).cast("bigint")
    base = t.hot.select("event_id", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), F.col("acq_date").alias("d"))
    events = base.where(i % 2 == 0).select("event_id", "latitude", "longitude", F.when(i % 14 == 0, F.date_add("d", 400)).otherwise(F.col("d")).alias("event_date"), linked.alias("weather_id"))
    weather = base.where(i % 2 == 1).select(
        i.alias("weather_id"), "latitude", "longitude", F.col("d").alias("datetime_record"))
    return relational.link_fire_to_weather(events, weather).select("event_id", "weather_id")


_NEAR_SQL = """
, rk AS (SELECT {key}, r.location_id, {dist} AS d, row_number() OVER (PARTITION BY {key} ORDER BY {dist}, r.location_id) AS rn
         FROM {source}, registry r)"""


@query("nearest_grid_point", _NEAR_SQL.format(
    key="_id", source="facility f", dist=haversine("latitude", "longitude", "grid_latitude", "grid_longitude", "6371000.0")) + """
SELECT _id, CASE WHEN latitude IS NULL THEN NULL ELSE rk.location_id END AS location_id,
  CASE WHEN latitude IS NULL THEN NULL ELSE round(d,2) END AS distance_to_grid_m,
  CASE WHEN latitude IS NULL THEN 'no_facility_lat_lon' WHEN d <= 1000 THEN 'matched' ELSE 'matched_far_check_needed' END AS location_match_status
FROM facility LEFT JOIN rk USING (_id) WHERE rn = 1""", "facility registry")
def nearest_grid_point(t: Tables):
    out = relational.nearest_grid_point(t.facility, t.registry)
    return out.select("_id", "location_id", "distance_to_grid_m", "location_match_status")


@query("nearest_grid_point_summary", _NEAR_SQL.format(
    key="_id", source="facility f", dist=haversine("latitude", "longitude", "grid_latitude", "grid_longitude", "6371000.0")) + """
SELECT CASE WHEN latitude IS NULL THEN 'no_facility_lat_lon' WHEN d <= 1000 THEN 'matched' ELSE 'matched_far_check_needed' END
  AS location_match_status, count(*) AS rows FROM facility LEFT JOIN rk USING (_id) WHERE rn = 1 GROUP BY 1""", "facility registry")
def nearest_grid_point_summary(t: Tables):
    return relational.match_summary(relational.nearest_grid_point(t.facility, t.registry))


_W = [0.02, 0.05, 0.1, 0.25, 0.5, 1.0]
_TIER = "CASE " + " ".join(
    f"WHEN grid_latitude BETWEEN latitude-{w} AND latitude+{w} AND grid_longitude BETWEEN longitude-{w} AND longitude+{w} THEN {i}"
    for i, w in enumerate(_W)) + " ELSE 6 END"


@query("nearest_registry_windowed", f"""
, inc AS (SELECT event_id, lat AS latitude, lon AS longitude FROM hot),
rk AS (SELECT event_id, location_id, {equirect('latitude','longitude','grid_latitude','grid_longitude')} AS km,
       row_number() OVER (PARTITION BY event_id ORDER BY {_TIER}, {equirect('latitude','longitude','grid_latitude','grid_longitude')}, location_id) AS rn
       FROM inc, registry WHERE latitude BETWEEN -39.2 AND -34.0 AND longitude BETWEEN 140.96 AND 150.0)
SELECT event_id, CASE WHEN km <= 20 THEN location_id END AS location_id, CASE WHEN km <= 20 THEN round(km,6) END AS km
FROM inc LEFT JOIN (SELECT * FROM rk WHERE rn = 1) USING (event_id)""", "hot registry")
def nearest_registry_windowed(t: Tables):
    inc = t.hot.select("event_id", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"))
    return rounded(relational.incident_locations(inc, t.registry), "km").select("event_id", "location_id", "km")


@query("nearest_grid_degrees", _NEAR_SQL.format(key="_id", source="facility f",
       dist=euclid("latitude", "longitude", "grid_latitude", "grid_longitude")) + """
SELECT _id, CASE WHEN latitude IS NULL THEN NULL ELSE r.region_name END AS region_name, CASE WHEN latitude IS NULL THEN NULL ELSE round(d,6) END AS distance_deg
FROM facility LEFT JOIN rk USING (_id) LEFT JOIN registry r ON r.location_id = rk.location_id WHERE rn = 1""", "facility registry")
def nearest_grid_degrees(t: Tables):
    out = relational.nearest_grid_degrees(t.facility, t.registry, ("latitude", "longitude"), ("grid_latitude", "grid_longitude"),
                                          "location_id", ["region_name"])
    return out.select("_id", "region_name", r6("distance_deg").alias("distance_deg"))


# -- polygons ---------------------------------------------------------------

_IN = "abs(h.lon-f.lon)+abs(h.lat-f.lat) < f.half"
SIZE = 0.05


@query("point_in_polygon_left", f"""
SELECT event_id, fire_id FROM hot h LEFT JOIN fires f ON {_IN}""", "hot fires")
def point_in_polygon_left(t: Tables):
    polys = t.fire_shapes.select("fire_id", "rings")
    return polygons.points_in_polygons(t.hot.select("event_id", "lat", "lon"), polys, "lon", "lat", "rings", SIZE, "left").select(
        "event_id", "fire_id")


_BOUND = "(SELECT avg_lat AS lat, avg_lon AS lon, 2.5::DOUBLE AS half FROM (SELECT round(avg(lat),2) AS avg_lat, round(avg(lon),2) AS avg_lon FROM hot))"


def _boundary(t: Tables):
    b = t.hot.agg(F.round(F.avg("lat"), 2).alias("lat"), F.round(F.avg("lon"), 2).alias("lon"))
    return b.select(diamond(F.col("lon"), F.col("lat"), F.lit(2.5)).alias("rings"))


@query("clip_points", f"SELECT event_id, h.acq_date, h.acq_time FROM hot h, {_BOUND} f WHERE {_IN}", "hot")
def clip_points(t: Tables):
    kept = polygons.points_in_polygons(t.hot, _boundary(t), "lon", "lat", "rings", 0.25, "left_semi")
    return kept.select("event_id", "acq_date", "acq_time")


# the boundary is |u| + |v| <= half around its centre: between the places where a cell's lines meet it, top and bottom are straight
@query("clip_cells", f"""
, c AS (SELECT DISTINCT floor(lon/0.25)::BIGINT AS x, floor(lat/0.25)::BIGINT AS y FROM hot),
r AS (SELECT x, y, f.lon AS cx, f.lat AS cy, f.half AS r, x*0.25::DOUBLE - f.lon AS u0, (x+1)*0.25::DOUBLE - f.lon AS u1, y*0.25::DOUBLE - f.lat AS v0, (y+1)*0.25::DOUBLE - f.lat AS v1 FROM c, {_BOUND} f),
k AS (SELECT DISTINCT x, y, least(greatest(unnest([u0, u1, 0, r, -r, r-abs(v0), abs(v0)-r, r-abs(v1), abs(v1)-r]), u0), u1) AS a FROM r),
s AS (SELECT x, y, a, lead(a) OVER (PARTITION BY x, y ORDER BY a) AS b FROM k),
t AS (SELECT s.*, cx, cy, least(v1, r-abs(a)) AS ta, greatest(v0, abs(a)-r) AS ba, least(v1, r-abs(b)) AS tb, greatest(v0, abs(b)-r) AS bb FROM s JOIN r USING (x, y) WHERE b > a),
m AS (SELECT x, y, cx, cy, sum((b-a)*(ta-ba+tb-bb)/2) AS area, sum((b-a)*((ta-ba)*(2*a+b)+(tb-bb)*(a+2*b))/6) AS mu,
  sum((b-a)*(ta*ta+ta*tb+tb*tb-ba*ba-ba*bb-bb*bb)/6) AS mv FROM t WHERE ta-ba+tb-bb > 0 GROUP BY ALL)
SELECT x, y, round(area,6) AS clipped_area, round(cx+mu/area,6) AS centroid_x, round(cy+mv/area,6) AS centroid_y FROM m WHERE area > 1e-9""", "hot")
def clip_cells(t: Tables):
    """Cells holding detections cut to the boundary; the buckets of the join are not aligned with them."""
    s = 0.25
    cells = t.hot.select(F.floor(F.col("lon") / s).alias("x"), F.floor(F.col("lat") / s).alias("y")).distinct().select(
        "x", "y", (F.col("x") * s).alias("w"), (F.col("y") * s).alias("s"), ((F.col("x") + 1) * s).alias("e"), ((F.col("y") + 1) * s).alias("n"))
    out = polygons.clip_cells(cells, _boundary(t), ("w", "s", "e", "n"), "rings", 0.4).where("clipped_area > 1e-9")
    return rounded(out, "clipped_area", "centroid_x", "centroid_y").select("x", "y", "clipped_area", "centroid_x", "centroid_y")


def cells_of(t: Tables):
    """Half-tenth-degree cells of the detections with their boxes."""
    x, y = F.floor(F.col("lon") / 0.05), F.floor(F.col("lat") / 0.05)
    return t.hot.select(x.alias("x"), y.alias("y")).distinct().select(
        "x", "y", (F.col("x") * F.lit(0.05)).alias("w"), (F.col("y") * F.lit(0.05)).alias("s"),
        ((F.col("x") + 1) * F.lit(0.05)).alias("e"), ((F.col("y") + 1) * F.lit(0.05)).alias("n"))


CELLS_SQL = """
, cc AS (SELECT DISTINCT floor(lon/0.05)::BIGINT AS x, floor(lat/0.05)::BIGINT AS y FROM hot),
cb AS (SELECT x, y, x*0.05::DOUBLE AS w, y*0.05::DOUBLE AS s, (x+1)*0.05::DOUBLE AS e, (y+1)*0.05::DOUBLE AS n FROM cc)"""
_HIT = "greatest(w-f.lon, f.lon-e, 0)+greatest(s-f.lat, f.lat-n, 0) <= f.half"


@query("fires_x_grid", CELLS_SQL + f"SELECT fire_id, x, y FROM cb, fires f WHERE {_HIT}", "hot fires")
def fires_x_grid(t: Tables):
    return polygons.boxes_intersect_polygons(
        cells_of(t), t.fire_shapes.select("fire_id", "rings"), ("w", "s", "e", "n"), "rings", SIZE).select("fire_id", "x", "y")


# area of a diamond of half diagonal h left of u and below v, both counted from its centre, in closed form; four corners give a cell's part
def _strip(w: str) -> str:
    return f"CASE WHEN v < 0 THEN greatest({w}+v, 0)*greatest({w}+v, 0)/2 WHEN {w} <= v THEN ({w})*({w}) ELSE v*v + v*({w}-v) + (({w})*({w})-v*v)/2 END"


OVERLAY_SQL = CELLS_SQL + f"""
, cn AS (SELECT x, y, fire_id, half AS h, sx*sy AS sign, least(greatest((CASE sx WHEN 1 THEN e ELSE w END)-f.lon, -half), half) AS u,
  least(greatest((CASE sy WHEN 1 THEN n ELSE s END)-f.lat, -half), half) AS v FROM cb JOIN fires f ON {_HIT}, (VALUES (1),(-1)) a(sx), (VALUES (1),(-1)) b(sy)),
ov AS (SELECT fire_id, x, y, sum(sign * CASE WHEN u <= 0 THEN {_strip('(h+u)')} ELSE 2*({_strip('h')}) - ({_strip('(h-u)')}) END) AS area, 2*max(h)*max(h) AS of_area
  FROM cn GROUP BY 1, 2, 3 HAVING area > 0.0025*1e-9)"""


def overlays(t: Tables):
    """Cells and fires with the area they share, without slivers of less than a billionth of a cell."""
    pairs = polygons.overlay_areas(cells_of(t), t.fire_shapes.select("fire_id", "rings"), ("w", "s", "e", "n"), "rings", SIZE)
    return pairs.where("overlap_area > 0.0025*1e-9D").select("fire_id", "x", "y", "overlap_area", "overlap_share")


@query("overlay_areas", OVERLAY_SQL + "SELECT fire_id, x, y, round(area,9) AS overlap_area, round(area/of_area,5) AS overlap_share FROM ov", "hot fires")
def overlay_areas(t: Tables):
    return overlays(t).withColumns({"overlap_area": F.round("overlap_area", 9), "overlap_share": F.round("overlap_share", 5)})


@query("detections_x_fires", CELLS_SQL + f"""
, d AS (SELECT event_id, frp, ts, floor(lon/0.05)::BIGINT AS x, floor(lat/0.05)::BIGINT AS y FROM hot)
SELECT event_id, fire_id, ts AS datetime, ignition_date FROM d JOIN cb USING (x, y) JOIN fires f ON {_HIT}""", "hot fires")
def detections_x_fires(t: Tables):
    cells = polygons.boxes_intersect_polygons(
        cells_of(t), t.fire_shapes.select("fire_id", "ignition_date", "rings"), ("w", "s", "e", "n"), "rings", SIZE)
    d = t.hot.select("event_id", F.col("ts").alias("datetime"), F.floor(F.col("lon") / 0.05).alias("x"), F.floor(F.col("lat") / 0.05).alias("y"))
    return copies.many_to_many(d, cells.select("x", "y", "fire_id", "ignition_date"), ["x", "y"]).drop("x", "y")


@query("detections_within_fires", f"""
SELECT event_id, lat, lon FROM hot h WHERE EXISTS (SELECT 1 FROM fires f WHERE {_IN})""", "hot fires")
def detections_within_fires(t: Tables):
    return polygons.points_in_polygons(
        t.hot.select("event_id", "lat", "lon"), t.fire_shapes.select("rings"), "lon", "lat", "rings", SIZE, "left_semi").distinct()


@query("centroid_in_cell", "SELECT fire_id, floor((round(lon,9)-140.0)/0.1)::BIGINT AS cell_x, floor((round(lat,9)+40.0)/0.1)::BIGINT AS cell_y FROM fires", "fires")
def centroid_in_cell(t: Tables):
    shapes = t.fire_shapes.select("fire_id", "rings")
    out = polygons.centroid_in_cell(shapes, "rings", 0.1, (140.0, -40.0))
    # a centroid is exact only up to rounding, so both engines bin it at nine decimals
    x, y = F.round("centroid_x", 9), F.round("centroid_y", 9)
    return out.select("fire_id", F.floor((x - F.lit(140.0)) / F.lit(0.1)).alias("cell_x"), F.floor((y + F.lit(40.0)) / F.lit(0.1)).alias("cell_y"))


@query("semi_by_ids", "SELECT fire_id, area_ha FROM fires WHERE fire_id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')", "fires")
def semi_by_ids(t: Tables):
    ids = t.table("lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("fire_id"))
    return relational.semi_by_ids(t.fires, ids, "fire_id").select("fire_id", "area_ha")


@query("merge_one_to_one", """
SELECT cell, ts, is_burning, quantity AS era5_quantity, price AS era5_price, discount AS era5land_discount, tax AS era5land_tax FROM obs""", "obs")
def merge_one_to_one(t: Tables):
    a = t.obs.select("cell", "ts", "is_burning", "quantity", "price")
    b = t.obs.select("cell", "ts", "is_burning", "discount", "tax")
    return environment.merge_one_to_one(a, b, ["cell", "ts"], ["is_burning"])


@query("label_spine_left", """
, f AS (SELECT l_suppkey AS cell, l_shipdate AS ts, max(CASE WHEN l_quantity > 45 THEN 1 ELSE 0 END) AS b FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1,2)
SELECT obs.cell, obs.ts, quantity, coalesce(b, 0)::INT AS is_burning FROM obs LEFT JOIN f ON f.cell = obs.cell AND f.ts = obs.ts""", "obs")
def label_spine_left(t: Tables):
    fires = t.table("lineitem").where("l_returnflag = 'R'").select(
        F.col("l_suppkey").alias("cell"), F.col("l_shipdate").alias("ts"), F.when(F.col("l_quantity") > 45, 1).otherwise(0).alias("is_burning"))
    return relational.label_spine_left(t.obs.select("cell", "ts", "quantity"), fires, ["cell", "ts"])


@query("merge_grids", """
SELECT c_custkey AS location_id, c_acctbal AS temperature, n_orders AS humidity, s_acctbal AS wind FROM customer
JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1) ON o_custkey = c_custkey JOIN supplier ON s_suppkey = c_custkey""")
def merge_grids(t: Tables):
    a = t.table("customer").select(F.col("c_custkey").alias("location_id"), F.col("c_acctbal").alias("temperature"))
    b = t.table("orders").groupBy(F.col("o_custkey").alias("location_id")).agg(F.count(F.lit(1)).alias("humidity"))
    c = t.table("supplier").select(F.col("s_suppkey").alias("location_id"), F.col("s_acctbal").alias("wind"))
    return relational.merge_layers([a, b, c])


def _geo_cache(t: Tables):
    """Cached lookups for all address texts; every fifth is a known miss."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    road, town = (k % 40).cast("string"), n.cast("string")
    base = t.table("customer").select(
        F.when(k % 2 == 0, F.concat(F.lit("Road "), road, F.lit(", Town "), town, F.lit(", VIC, Australia")))
        .otherwise(F.concat(F.lit("Road "), road, F.lit(", Town "), town, F.lit(", Victoria, Australia"))).alias("query"), k.alias("k"))
    best = base.groupBy("query").agg(F.min("k").alias("k"))
    hit = F.col("k") % 5 != 0
    return best.select("query", F.when(hit, F.lit(-37.0) - F.col("k") / 1000.0).alias("latitude"),
                       F.when(hit, F.lit(145.0) + F.col("k") / 1000.0).alias("longitude"),
                       F.concat(F.lit("Place "), F.col("k").cast("string")).alias("display_name"))


_GEO_SQL = """
, c0 AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'Road '||(c_custkey%40)::VARCHAR||', Town '||c_nationkey::VARCHAR||', VIC, Australia'
         ELSE 'Road '||(c_custkey%40)::VARCHAR||', Town '||c_nationkey::VARCHAR||', Victoria, Australia' END AS query, min(c_custkey) AS k
         FROM customer GROUP BY 1),
c AS (SELECT query, -37.0::DOUBLE - k/1000.0::DOUBLE AS la, 145.0::DOUBLE + k/1000.0::DOUBLE AS lo, 'Place '||k::VARCHAR AS dn FROM c0 WHERE k % 5 <> 0),
q AS (SELECT _id, facility_address||', '||suburb||', VIC, Australia' AS q1, facility_address||', '||suburb||', Victoria, Australia' AS q2,
      facility_name||', '||suburb||', VIC, Australia' AS q3, facility_address||', '||suburb||', '||lga||', Victoria, Australia' AS q4, latitude, longitude FROM facility),
g AS (SELECT q._id, q1, latitude, longitude, coalesce(a.query,b.query,d.query,e.query) AS hq, coalesce(a.la,b.la,d.la,e.la) AS hla,
      coalesce(a.lo,b.lo,d.lo,e.lo) AS hlo, coalesce(a.dn,b.dn,d.dn,e.dn) AS hdn
      FROM q LEFT JOIN c a ON a.query=q1 LEFT JOIN c b ON b.query=q2 LEFT JOIN c d ON d.query=q3 LEFT JOIN c e ON e.query=q4),
r AS (SELECT _id, CASE WHEN done THEN latitude ELSE hla END AS latitude, CASE WHEN done THEN longitude ELSE hlo END AS longitude,
      CASE WHEN done OR hq IS NOT NULL THEN 'matched' ELSE 'not_matched' END AS geocode_status,
      CASE WHEN done THEN NULL ELSE coalesce(hq, q1) END AS geocode_query, CASE WHEN done THEN NULL ELSE hdn END AS geocode_display_name
      FROM (SELECT *, _id % 4 = 1 AND latitude IS NOT NULL AS done FROM g))"""


def _geocoded(t: Tables):
    done = (F.col("_id") % 4 == 1) & F.col("latitude").isNotNull()
    fac = t.facility.withColumns({
        "geocode_status": F.when(done, "matched"), "geocode_source": F.lit(None).cast("string"),
        "geocode_query": F.lit(None).cast("string"), "geocode_display_name": F.lit(None).cast("string"),
    })
    return relational.geocode_from_cache(fac, _geo_cache(t), "address cache")


@query("geocode_from_cache", _GEO_SQL + """
SELECT _id, round(latitude,6) AS latitude, round(longitude,6) AS longitude, geocode_status, geocode_query, geocode_display_name FROM r""", "facility")
def geocode_from_cache(t: Tables):
    return rounded(_geocoded(t), "latitude", "longitude").select(
        "_id", "latitude", "longitude", "geocode_status", "geocode_query", "geocode_display_name")


@query("geocode_summary", _GEO_SQL + """
SELECT count(*) AS total, count(*) AS processed, count(*) FILTER (geocode_status = 'matched') AS matched,
       count(*) FILTER (geocode_status = 'not_matched') AS not_matched, 0::BIGINT AS remaining, true AS complete FROM r""", "facility")
def geocode_summary(t: Tables):
    return relational.geocode_summary(_geocoded(t))


@query("feature_forecast_join", """
SELECT CASE WHEN c_custkey % 7 = 0 THEN c_custkey::VARCHAR ELSE 'f' || c_custkey::VARCHAR END AS id, c_custkey AS position,
       c_acctbal AS forecast FROM customer""")
def feature_forecast_join(t: Tables):
    k = F.col("c_custkey")
    named = F.when(k % 7 != 0, F.concat(F.lit("f"), k.cast("string")))
    features = t.table("customer").select(k.alias("position"), named.alias("id"))
    forecasts = t.table("customer").select(k.alias("position"), named.alias("id"), F.col("c_acctbal").alias("forecast"))
    return relational.feature_forecast_join(features, forecasts)


@query("suburb_reference", _NEAR_SQL.format(key="_id", source="facility f",
       dist=haversine("latitude", "longitude", "grid_latitude", "grid_longitude")) + """
SELECT _id, CASE WHEN _id % 3 = 0 THEN NULL ELSE 'A' END AS rating, rk.location_id, round(d,6) AS distance_km
FROM facility JOIN rk USING (_id) WHERE rn = 1 AND latitude IS NOT NULL""", "facility registry")
def suburb_reference(t: Tables):
    fac = t.facility.select("_id", F.when(F.col("_id") % 3 == 0, "  ").otherwise("A ").alias("rating"),
                            F.coalesce(F.col("latitude").cast("string"), F.lit("n/a")).alias("latitude"),
                            F.coalesce(F.col("longitude").cast("string"), F.lit("")).alias("longitude"))
    return rounded(relational.suburb_reference(fac, t.registry), "distance_km").select("_id", "rating", "location_id", "distance_km")


# -- interpolation ----------------------------------------------------------

@query("interpolate_nearest", f"""
, s AS (SELECT event_id, lat, lon, frp, brightness FROM hot WHERE acq_date = (SELECT max(acq_date) FROM hot)),
rk AS (SELECT location_id, frp, brightness, row_number() OVER (PARTITION BY location_id ORDER BY
       {euclid('grid_latitude','grid_longitude','lat','lon')}, event_id) AS rn FROM registry, s)
SELECT location_id, frp, brightness FROM rk WHERE rn = 1""", "hot registry")
def interpolate_nearest(t: Tables):
    """Every registry cell at one time, the newest day: its nearest detection."""
    newest = t.hot.where(F.col("acq_date") == t.hot.agg(F.max("acq_date")).scalar())
    out = interpolation.nearest_to_grid(newest, t.registry, ("lat", "lon"), ("grid_latitude", "grid_longitude"), ["frp", "brightness"], "event_id")
    return out.select("location_id", "frp", "brightness")


@query("interpolate_idw", f"""
, s AS (SELECT event_id, lat, lon, frp FROM hot),
rk AS (SELECT location_id, frp, {euclid('grid_latitude','grid_longitude','lat','lon')} AS d, row_number() OVER (PARTITION BY location_id ORDER BY
       {euclid('grid_latitude','grid_longitude','lat','lon')}, event_id) AS rn FROM registry, s)
SELECT location_id, round(coalesce(avg(frp) FILTER (d = 0), sum(frp/(d*d)) FILTER (d > 0)/sum(1/(d*d)) FILTER (d > 0)),6) AS frp
FROM rk WHERE rn <= 4 GROUP BY 1""", "hot registry")
def interpolate_idw(t: Tables):
    out = interpolation.idw_to_grid(t.hot, t.registry, ("lat", "lon"), ("grid_latitude", "grid_longitude"), ["frp"], "event_id")
    return rounded(out.select("location_id", "frp"), "frp")


def _mesh(t: Tables):
    """Half-degree mesh of mean power; only meshes with detections exist."""
    return t.hot.groupBy(F.floor((F.col("lat") + 40.0) / 0.5).alias("mesh_row"), F.floor((F.col("lon") - 140.0) / 0.5).alias("mesh_col")).agg(
        F.max("frp").alias("frp"))


@query("interpolate_mesh_bilinear", """
, m AS (SELECT floor((lat+40.0)/0.5)::BIGINT AS r, floor((lon-140.0)/0.5)::BIGINT AS c, max(frp) AS v FROM hot GROUP BY 1,2),
p AS (SELECT location_id, (grid_latitude-(-40.0))/0.5 AS fy, (grid_longitude-140.0)/0.5 AS fx FROM registry),
n AS (SELECT location_id, floor(fy)::BIGINT+i AS r, floor(fx)::BIGINT+j AS c,
      (CASE WHEN i=0 THEN 1-(fy-floor(fy)) ELSE fy-floor(fy) END)*(CASE WHEN j=0 THEN 1-(fx-floor(fx)) ELSE fx-floor(fx) END) AS w
      FROM p, range(0,2) a(i), range(0,2) b(j)),
g AS (SELECT location_id, count(*) AS need, count(v) AS got, sum(w*v) AS v FROM n LEFT JOIN m USING (r,c) WHERE w <> 0 GROUP BY 1)
SELECT location_id, CASE WHEN need = got THEN round(v,6) END AS frp FROM registry LEFT JOIN g USING (location_id)""", "hot registry")
def interpolate_mesh_bilinear(t: Tables):
    out = interpolation.mesh_to_grid(_mesh(t), t.registry, ("grid_latitude", "grid_longitude"), (-40.0, 140.0), (0.5, 0.5), ["frp"])
    return rounded(out.select("location_id", "frp"), "frp")


@query("interpolate_mesh_bicubic", """
, m AS (SELECT floor((lat+40.0)/0.5)::BIGINT AS r, floor((lon-140.0)/0.5)::BIGINT AS c, max(frp) AS v FROM hot GROUP BY 1,2),
p AS (SELECT location_id, (grid_latitude-(-40.0))/0.5 AS fy, (grid_longitude-140.0)/0.5 AS fx FROM registry),
q AS (SELECT *, fy-floor(fy) AS ty, fx-floor(fx) AS tx FROM p),
n AS (SELECT location_id, floor(fy)::BIGINT+i AS r, floor(fx)::BIGINT+j AS c,
  (CASE i WHEN -1 THEN -0.5*ty*ty*ty+ty*ty-0.5*ty WHEN 0 THEN 1.5*ty*ty*ty-2.5*ty*ty+1 WHEN 1 THEN -1.5*ty*ty*ty+2*ty*ty+0.5*ty ELSE 0.5*ty*ty*ty-0.5*ty*ty END)*
  (CASE j WHEN -1 THEN -0.5*tx*tx*tx+tx*tx-0.5*tx WHEN 0 THEN 1.5*tx*tx*tx-2.5*tx*tx+1 WHEN 1 THEN -1.5*tx*tx*tx+2*tx*tx+0.5*tx ELSE 0.5*tx*tx*tx-0.5*tx*tx END) AS w
  FROM q, range(-1,3) a(i), range(-1,3) b(j)),
g AS (SELECT location_id, count(*) AS need, count(v) AS got, sum(w*v) AS v FROM n LEFT JOIN m USING (r,c) WHERE w <> 0 GROUP BY 1)
SELECT location_id, CASE WHEN need = got THEN round(v,6) END AS frp FROM registry LEFT JOIN g USING (location_id)""", "hot registry")
def interpolate_mesh_bicubic(t: Tables):
    out = interpolation.mesh_to_grid(_mesh(t), t.registry, ("grid_latitude", "grid_longitude"), (-40.0, 140.0), (0.5, 0.5), ["frp"], "bicubic")
    return rounded(out.select("location_id", "frp"), "frp")


@query("registry_in_range", "SELECT location_id, region_name FROM registry WHERE location_id BETWEEN 1 AND 463807", "registry")
def registry_in_range(t: Tables):
    from emberfield.sources.readers import load_registry

    return load_registry(t.registry).select("location_id", "region_name")


