"""Grid, hub, distance, projection and polygon-shape queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberfield.functions import geometry, grid, time
from emberfield.operators import hubs
from emberfield.plans.bindings import Tables, lat_of, lon_of
from emberfield.plans.registry import query, r6
from emberfield.plans.sqlviews import _lat, _lon, euclid, equirect, haversine, season


@query("snap_round", "SELECT event_id, round_even(lat/0.1,0)::BIGINT AS lat_idx, round_even(lon/0.1,0)::BIGINT AS lon_idx, "
       "round(round_even(lat/0.1,0)*0.1::DOUBLE,6) AS grid_lat, round(round_even(lon/0.1,0)*0.1::DOUBLE,6) AS grid_lon FROM hot", "hot")
def snap_round(t: Tables):
    return t.hot.select(
        "event_id", grid.cell_index(F.col("lat"), 0.1).alias("lat_idx"), grid.cell_index(F.col("lon"), 0.1).alias("lon_idx"),
        r6(grid.snap_round(F.col("lat"))).alias("grid_lat"), r6(grid.snap_round(F.col("lon"))).alias("grid_lon"),
    )


@query("snap_round4", "SELECT round(round_even(lat/0.1,0)*0.1::DOUBLE,4) AS grid_lat, round(round_even(lon/0.1,0)*0.1::DOUBLE,4) AS grid_lon, "
       "count(*) AS n FROM hot GROUP BY 1,2", "hot")
def snap_round4(t: Tables):
    return t.hot.groupBy(grid.snap_round4(F.col("lat")).alias("grid_lat"), grid.snap_round4(F.col("lon")).alias("grid_lon")).agg(
        F.count(F.lit(1)).alias("n"))


@query("snap_floor_center", "SELECT event_id, round(floor(lat/0.05)*0.05::DOUBLE+0.025,5) AS grid_lat, "
       "round(floor(lon/0.05)*0.05::DOUBLE+0.025,5) AS grid_lon FROM hot", "hot")
def snap_floor_center(t: Tables):
    return t.hot.select("event_id", grid.snap_floor_center(F.col("lat")).alias("grid_lat"), grid.snap_floor_center(F.col("lon")).alias("grid_lon"))


@query("snap_2dp", "SELECT round_even(lat*100.0::DOUBLE,0)/100.0::DOUBLE AS lat2, round_even(lon*100.0::DOUBLE,0)/100.0::DOUBLE AS lon2, "
       "count(*) AS n FROM hot GROUP BY 1,2", "hot")
def snap_2dp(t: Tables):
    return t.hot.groupBy(grid.snap_2dp(F.col("lat")).alias("lat2"), grid.snap_2dp(F.col("lon")).alias("lon2")).agg(F.count(F.lit(1)).alias("n"))


_MX = "radians({0})*6378137.0"
_MY = "ln(tan(pi()/4+radians({0})/2))*6378137.0"


@query("cell_index_3857", f"""
, c AS (SELECT event_id, floor(({_MX.format('lon')} - 15640000.0)/5000.0)::BIGINT AS cell_x,
        floor(({_MY.format('lat')} - (-4810000.0))/5000.0)::BIGINT AS cell_y FROM hot)
SELECT event_id, cell_x, cell_y, cell_y*1000000+cell_x AS grid_id FROM c""", "hot")
def cell_index_3857(t: Tables):
    from emberfield.operators.satellite import with_metric_cells

    cells = with_metric_cells(t.hot, "lat", "lon", 5000.0, 15641234.0, -4809000.0)
    return cells.select("event_id", "cell_x", "cell_y", "grid_id")


@query("in_bounds", "SELECT satellite, count(*) FILTER (lat BETWEEN -39.20 AND -33.98 AND lon BETWEEN 141.0 AND 150.0) AS state_box, "
       "count(*) FILTER (lat BETWEEN -39.2 AND -34.0 AND lon BETWEEN 140.96 AND 150.0) AS registry_box, count(*) AS n FROM hot GROUP BY 1", "hot")
def in_bounds(t: Tables):
    return t.hot.groupBy("satellite").agg(
        F.count_if(grid.in_bounds(F.col("lat"), F.col("lon"))).alias("state_box"),
        F.count_if(grid.in_bounds(F.col("lat"), F.col("lon"), grid.REGISTRY_BOX)).alias("registry_box"), F.count(F.lit(1)).alias("n"))


def _places(rows) -> str:
    return ", ".join(f"({i}, '{n}', ({a})::DOUBLE, ({b})::DOUBLE)" for i, (n, a, b) in enumerate(rows))


def _nearest_sql(rows, dist: str, source: str, key: str) -> str:
    return f"""
, pl AS (SELECT * FROM (VALUES {_places(rows)}) v(i, name, pla, plo)),
rk AS (SELECT {key}, name, row_number() OVER (PARTITION BY {key} ORDER BY {dist}, i) AS rn FROM {source} s, pl)"""


def _sources(t: Tables):
    """Five observation sources sharing one registry, as in the batch load."""
    base = [F.col("lat").alias("original_latitude"), F.col("lon").alias("original_longitude")]
    fire = t.hot.select("event_id", *base, F.col("ts").alias("datetime_record"))
    reg = t.registry.select(F.col("location_id").alias("event_id"), F.col("grid_latitude").alias("original_latitude"),
                            F.col("grid_longitude").alias("original_longitude"))
    return [fire, reg]


@query("build_location_registry", _nearest_sql(
    grid.REGION_CENTRES, euclid("lat_idx*0.1::DOUBLE", "lon_idx*0.1::DOUBLE", "pla", "plo"), "loc", "location_id") + """
SELECT l.location_id, lat_idx, lon_idx, round(lat_idx*0.1::DOUBLE,6) AS grid_latitude, round(lon_idx*0.1::DOUBLE,6) AS grid_longitude,
       name AS region_name FROM loc l JOIN rk ON rk.location_id = l.location_id AND rn = 1""", "loc")
def build_location_registry(t: Tables):
    loc, _ = t.hubs
    return loc.withColumns({"grid_latitude": r6("grid_latitude"), "grid_longitude": r6("grid_longitude")})


@query("location_registry_first_seen", """
, allobs AS (SELECT 0 AS src, event_id AS ord, lat, lon FROM hot UNION ALL
             SELECT 1, location_id, grid_latitude, grid_longitude FROM registry),
c AS (SELECT round_even(lat/0.1,0)::BIGINT AS lat_idx, round_even(lon/0.1,0)::BIGINT AS lon_idx, min((src, ord)) AS seen
      FROM allobs WHERE lat BETWEEN -39.2 AND -33.98 AND lon BETWEEN 141.0 AND 150.0 GROUP BY 1,2)
SELECT row_number() OVER (ORDER BY seen) AS location_id, lat_idx, lon_idx FROM c""", "hot registry")
def location_registry_first_seen(t: Tables):
    return hubs.location_registry(_sources(t), order="first_seen", arrival="event_id").select("location_id", "lat_idx", "lon_idx")


@query("get_or_create_location", """
, r0 AS (SELECT DISTINCT round_even(grid_latitude/0.1,0)::BIGINT AS lat_idx, round_even(grid_longitude/0.1,0)::BIGINT AS lon_idx
         FROM registry WHERE grid_latitude BETWEEN -39.2 AND -34.0 AND grid_longitude BETWEEN 140.96 AND 150.0),
r AS (SELECT row_number() OVER (ORDER BY lat_idx, lon_idx) AS location_id, * FROM r0),
h AS (SELECT DISTINCT round_even(lat/0.1,0)::BIGINT AS lat_idx, round_even(lon/0.1,0)::BIGINT AS lon_idx FROM hot
      WHERE lat BETWEEN -39.2 AND -34.0 AND lon BETWEEN 140.96 AND 150.0),
f AS (SELECT row_number() OVER (ORDER BY lat_idx, lon_idx) + (SELECT max(location_id) FROM r) AS location_id, * FROM h
      WHERE (lat_idx, lon_idx) NOT IN (SELECT (lat_idx, lon_idx) FROM r0))
SELECT location_id, round(lat_idx*0.1::DOUBLE,4) AS grid_latitude, round(lon_idx*0.1::DOUBLE,4) AS grid_longitude, 'Victoria' AS region_name
FROM (SELECT * FROM r UNION ALL SELECT * FROM f)""", "hot registry")
def get_or_create_location(t: Tables):
    from emberfield.operators.ordering import number_rows

    known = hubs.with_cell(
        t.registry.where(grid.in_bounds(F.col("grid_latitude"), F.col("grid_longitude"), grid.REGISTRY_BOX)),
        "grid_latitude", "grid_longitude").select("lat_idx", "lon_idx").distinct()
    registry = number_rows(known, ["lat_idx", "lon_idx"], "location_id").select(
        "location_id", "lat_idx", "lon_idx", F.round(F.col("lat_idx") * F.lit(0.1), 4).alias("grid_latitude"),
        F.round(F.col("lon_idx") * F.lit(0.1), 4).alias("grid_longitude"), F.lit("Victoria").alias("region_name"))
    return hubs.get_or_create_locations(t.hot, registry, "lat", "lon").drop("lat_idx", "lon_idx")


@query("region_nearest_euclid", _nearest_sql(grid.REGION_CENTRES, euclid("lat", "lon", "pla", "plo"), "hot", "event_id") + """
SELECT name AS region, count(*) AS n FROM rk WHERE rn = 1 GROUP BY 1""", "hot")
def region_nearest_euclid(t: Tables):
    return t.hot.groupBy(grid.region_nearest_euclid(F.col("lat"), F.col("lon")).alias("region")).agg(F.count(F.lit(1)).alias("n"))


@query("region_nearest_haversine", _nearest_sql(grid.LOCALITIES, haversine("lat", "lon", "pla", "plo"), "hot", "event_id") + """
SELECT event_id, name AS region FROM rk WHERE rn = 1""", "hot")
def region_nearest_haversine(t: Tables):
    return t.hot.select("event_id", grid.region_nearest_haversine(F.col("lat"), F.col("lon")).alias("region"))


@query("haversine_km", f"SELECT event_id, round({haversine('lat','lon','(-37.81)','144.96')},6) AS km, "
       f"round({haversine('lat','lon','(-37.81)','144.96','6371000.0')},3) AS metres FROM hot", "hot")
def haversine_km(t: Tables):
    a, b = F.lit(-37.81), F.lit(144.96)
    return t.hot.select("event_id", r6(grid.haversine_km(F.col("lat"), F.col("lon"), a, b)).alias("km"),
                        F.round(grid.haversine_km(F.col("lat"), F.col("lon"), a, b, 6371000.0), 3).alias("metres"))


@query("equirect_km", f"SELECT event_id, round({equirect('lat','lon','(-37.81)','144.96')},6) AS km FROM hot", "hot")
def equirect_km(t: Tables):
    return t.hot.select("event_id", r6(grid.equirect_km(F.col("lat"), F.col("lon"), F.lit(-37.81), F.lit(144.96))).alias("km"))


@query("season", f"SELECT {season('CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate END')} AS season, "
       "count(*) AS n, count(o_orderkey) FILTER (o_orderkey % 11 = 0) AS unknown FROM orders GROUP BY 1")
def season_query(t: Tables):
    d = F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderdate"))
    return t.table("orders").groupBy(time.season(d).alias("season")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderkey") % 11 == 0).alias("unknown"))


@query("register_time", "SELECT time_id, datetime_record, season FROM tim", "tim")
def register_time(t: Tables):
    return t.hubs[1]


@query("time_id_yyyymmddhh", "SELECT strftime(ts,'%Y%m%d%H')::BIGINT AS time_id, strftime(ts,'%Y%m0100')::BIGINT AS month_id, "
       "count(*) AS n FROM hot GROUP BY 1,2", "hot")
def time_id(t: Tables):
    ts = F.col("ts")
    return t.hot.groupBy(time.hour_id(ts).alias("time_id"), time.month_id(F.year(ts), F.month(ts)).alias("month_id")).agg(
        F.count(F.lit(1)).alias("n"))


@query("generate_time_registry", f"""
, b AS (SELECT date_trunc('hour', min(ts)) AS a, date_trunc('hour', max(ts)) AS z FROM hot),
m AS (SELECT unnest(generate_series(a, z - INTERVAL 1 MINUTE, INTERVAL 1 MINUTE)) AS m FROM b)
SELECT strftime(m,'%Y%m%d%H')::BIGINT AS hour_id, m AS datetime_record, {season('m')} AS season FROM m""", "hot")
def generate_time_registry(t: Tables):
    bounds = t.hot.agg(time.floor_hour(F.min("ts")).alias("start"), time.floor_hour(F.max("ts")).alias("stop"))
    return hubs.minute_registry(bounds)


@query("align_observation", """
SELECT event_id, location_id, time_id, lat AS original_latitude, lon AS original_longitude, k AS confidence_score
FROM hot_in JOIN loc USING (lat_idx, lon_idx) JOIN tim ON datetime_record = date_trunc('hour', ts)""", "loc tim")
def align_observation(t: Tables):
    loc, tim = t.hubs
    obs = t.hot.select("event_id", F.col("lat").alias("original_latitude"), F.col("lon").alias("original_longitude"),
                       F.col("k").alias("confidence_score"), F.col("ts").alias("datetime_record"))
    return hubs.align_observation(obs, loc, tim, "event_id", ["original_latitude", "original_longitude", "confidence_score"])


@query("align_static", """
SELECT r.location_id AS asset_id, l.location_id, r.region_name AS facility_name FROM registry r
JOIN loc l ON l.lat_idx = round_even(grid_latitude/0.1,0)::BIGINT AND l.lon_idx = round_even(grid_longitude/0.1,0)::BIGINT
WHERE grid_latitude BETWEEN -39.2 AND -33.98 AND grid_longitude BETWEEN 141.0 AND 150.0""", "loc registry")
def align_static(t: Tables):
    loc, _ = t.hubs
    assets = t.registry.select(F.col("location_id").alias("asset_id"), F.col("region_name").alias("facility_name"),
                               F.col("grid_latitude").alias("original_latitude"), F.col("grid_longitude").alias("original_longitude"))
    return hubs.align_static(assets, loc, "asset_id", ["facility_name"])


def boundaries(t: Tables):
    """One diamond-shaped boundary per satellite around its mean position (projected-style units)."""
    from emberfield.plans.bindings import diamond

    b = t.hot.groupBy("satellite").agg(F.count(F.lit(1)).alias("n"), F.max("k").alias("k"))
    cx, cy = (F.col("n") % 97) * F.lit(10.0), (F.col("n") % 89) * F.lit(10.0)
    h = F.lit(155.5) + F.col("k")
    return b.select("satellite", cx.alias("cx"), cy.alias("cy"), h.alias("h"), diamond(cx, cy, h).alias("rings"))


BOUNDARY_SQL = """
, bd AS (SELECT satellite, (count(*) % 97)*10.0::DOUBLE AS cx, (count(*) % 89)*10.0::DOUBLE AS cy, 155.5::DOUBLE + max(k) AS h
         FROM hot GROUP BY 1),
cand AS (SELECT satellite, cx, cy, h, x, y, floor((cx-h)/20.0)*20.0 + x*20.0 AS x0, floor((cy-h)/20.0)*20.0 + y*20.0 AS y0
         FROM bd, range(0, 40) a(x), range(0, 40) b(y)),
cells AS (SELECT *, greatest(x0-cx, cx-(x0+20.0), 0)+greatest(y0-cy, cy-(y0+20.0), 0) AS d FROM cand WHERE x0 < cx+h AND y0 < cy+h)"""


@query("generate_grid", BOUNDARY_SQL + """
SELECT satellite, y::INT AS "row", x::INT AS "col", x0, y0 FROM cells WHERE d <= h""", "hot")
def generate_grid(t: Tables):
    return hubs.generate_grid(boundaries(t), "satellite", "rings", 20.0)


@query("cell_attributes", BOUNDARY_SQL + """
SELECT satellite, 'VIC_20M_' || printf('%05d', y) || '_' || printf('%05d', x) AS cell_id, 0.04::DOUBLE AS cell_area_ha
FROM cells WHERE d <= h""", "hot")
def cell_attributes(t: Tables):
    return hubs.cell_attributes(generate_grid(t), 20.0).select("satellite", "cell_id", "cell_area_ha")


@query("grid_from_lines", """
, v AS (SELECT fire_id, lon-half AS lon, lat FROM fires UNION ALL SELECT fire_id, lon, lat-half FROM fires
        UNION ALL SELECT fire_id, lon+half, lat FROM fires UNION ALL SELECT fire_id, lon, lat+half FROM fires)
SELECT DISTINCT lon, lat FROM v WHERE fire_id % 5 >= 3""", "fires")
def grid_from_lines(t: Tables):
    lines = t.fire_shapes.select(F.flatten("rings").alias("vertices"), (F.col("fire_id") % 5).alias("signif"))
    return hubs.grid_from_lines(lines, "vertices", "signif", 3)


@query("coarse_mesh", """
, b AS (SELECT satellite, min(lat) AS s, max(lat) AS n, min(lon) AS w, max(lon) AS e FROM hot GROUP BY 1),
st AS (SELECT 50.0::DOUBLE/111.0 AS dy, (50.0::DOUBLE/111.0)/cos(radians(37.0::DOUBLE)) AS dx)
SELECT r AS mesh_row, c AS mesh_col, round(s + r*dy, 6) AS lat, round(w + c*dx, 6) AS lon
FROM b, st, range(0, 40) a(r), range(0, 40) d(c) WHERE r <= floor((n-s)/dy) AND c <= floor((e-w)/dx)""", "hot")
def coarse_mesh(t: Tables):
    bounds = t.hot.groupBy("satellite").agg(F.min("lat").alias("south"), F.max("lat").alias("north"),
                                            F.min("lon").alias("west"), F.max("lon").alias("east"))
    m = hubs.coarse_mesh(bounds, 50.0)
    return m.select(F.col("mesh_row").cast("bigint").alias("mesh_row"), F.col("mesh_col").cast("bigint").alias("mesh_col"),
                    r6("lat").alias("lat"), r6("lon").alias("lon"))


@query("cell_polygon", """
SELECT location_id, 5::BIGINT AS points, round(grid_longitude-0.025,6) AS west, round(grid_latitude-0.025,6) AS south,
       round(grid_longitude+0.025,6) AS east, round(grid_latitude+0.025,6) AS north, true AS closed FROM registry""", "registry")
def cell_polygon(t: Tables):
    ring = F.get(grid.cell_polygon(F.col("grid_latitude"), F.col("grid_longitude")), F.lit(0))
    r = t.registry.select("location_id", ring.alias("r"))
    b = geometry.bounds(F.array("r"))
    return r.select("location_id", F.size("r").cast("bigint").alias("points"), r6(b["x0"]).alias("west"), r6(b["y0"]).alias("south"),
                    r6(b["x1"]).alias("east"), r6(b["y1"]).alias("north"), (F.get("r", F.lit(0)) == F.get("r", F.lit(4))).alias("closed"))


def geojson_text(t: Tables):
    """Polygon text per customer with integer coordinates, every 13th unreadable."""
    k = F.col("c_custkey")
    a, b = k % 90, k % 45
    pts = F.format_string("[[%d,%d],[%d,%d],[%d,%d],[%d,%d]]", a, b, a + 3, b, a + 3, b + 2, a, b)
    text = F.concat(F.lit('{"type":"Polygon","coordinates":['), pts, F.lit("]}"))
    return t.table("customer").select("c_custkey", F.when(k % 13 != 0, text).otherwise("not json").alias("geo"))


@query("ring_min_corner", """
SELECT c_custkey, CASE WHEN c_custkey % 13 <> 0 THEN (c_custkey % 90)::DOUBLE END AS lon,
       CASE WHEN c_custkey % 13 <> 0 THEN (c_custkey % 45)::DOUBLE END AS lat FROM customer""")
def ring_min_corner(t: Tables):
    c = geometry.ring_min_corner(F.col("geo"))
    return geojson_text(t).select("c_custkey", c["lon"].alias("lon"), c["lat"].alias("lat"))


@query("grid_row_col", """
, rr AS (SELECT lat, row_number() OVER (ORDER BY lat) - 1 AS "row" FROM (SELECT DISTINCT lat FROM hot)),
cc AS (SELECT lon, row_number() OVER (ORDER BY lon) - 1 AS "col" FROM (SELECT DISTINCT lon FROM hot))
SELECT event_id, "row", "col" FROM hot JOIN rr USING (lat) JOIN cc USING (lon)""", "hot")
def grid_row_col(t: Tables):
    return hubs.grid_row_col(t.hot, "lat", "lon").select("event_id", "row", "col")


@query("geometry_id", """
SELECT c_custkey, sha256('{"coordinates":[' || (c_custkey % 90)::VARCHAR || ',' || (c_custkey % 45)::VARCHAR || '],"type":"Point"}')
AS geometry_id FROM customer""")
def geometry_id(t: Tables):
    k = F.col("c_custkey")
    text = F.format_string('{ "type": "Point",  "coordinates": [%d, %d] }', k % 90, k % 45)
    return t.table("customer").select("c_custkey", geometry.geometry_id(text).alias("geometry_id"))


@query("polygon_measures", """
SELECT fire_id, round(2*half*half,6) AS area, round(4*sqrt(2.0)*half,6) AS perimeter, round(lon,6) AS centroid_x, round(lat,6) AS centroid_y,
       round(4*pi()*(2*half*half)/pow(4*sqrt(2.0)*half,2),6) AS compactness FROM fires""", "fires")
def polygon_measures(t: Tables):
    r = F.col("rings")
    c = geometry.centroid(r)
    m = t.fire_shapes.select("fire_id", geometry.area(r).alias("a"), geometry.perimeter(r).alias("p"), c.alias("c"))
    return m.select("fire_id", r6("a").alias("area"), r6("p").alias("perimeter"), r6(F.col("c.x")).alias("centroid_x"),
                    r6(F.col("c.y")).alias("centroid_y"), r6(geometry.compactness(F.col("a"), F.col("p"))).alias("compactness"))


_E2 = "0.006694380022903416"
_EC = f"sqrt({_E2})"


def _m(p: str) -> str:
    return f"(cos(radians({p}))/sqrt(1-{_E2}*pow(sin(radians({p})),2)))"


def _t(p: str) -> str:
    s = f"({_EC}*sin(radians({p})))"
    return f"(tan(pi()/4-radians({p})/2)/pow((1-{s})/(1+{s}),{_EC}/2))"


@query("reproject", f"""
, q AS (SELECT (ln({_m('-36.0')})-ln({_m('-38.0')}))/(ln({_t('-36.0')})-ln({_t('-38.0')})) AS n),
g AS (SELECT n, {_m('-36.0')}/(n*pow({_t('-36.0')},n)) AS f FROM q),
z AS (SELECT n, 6378137.0*f AS af, 6378137.0*f*pow({_t('-37.0')},n) AS rho0 FROM g)
SELECT event_id, round({_MX.format('lon')},3) AS merc_x, round({_MY.format('lat')},3) AS merc_y,
  round(2500000.0 + af*pow({_t('lat')},n)*sin(n*radians(lon-145.0)),3) AS vic_x,
  round(2500000.0 + rho0 - af*pow({_t('lat')},n)*cos(n*radians(lon-145.0)),3) AS vic_y,
  round(lat,6) AS back_lat, round(lon,6) AS back_lon FROM hot, z""", "hot")
def reproject(t: Tables):
    x, y = grid.vicgrid(F.col("lat"), F.col("lon"))
    moved = t.hot.select("event_id", "lat", "lon", x.alias("vx"), y.alias("vy"))
    blat, blon = grid.vicgrid_inverse(F.col("vx"), F.col("vy"))
    return moved.select(
        "event_id", F.round(grid.mercator_x(F.col("lon")), 3).alias("merc_x"), F.round(grid.mercator_y(F.col("lat")), 3).alias("merc_y"),
        F.round("vx", 3).alias("vic_x"), F.round("vy", 3).alias("vic_y"), r6(blat).alias("back_lat"), r6(blon).alias("back_lon"))


@query("snapped_registry_regions", f"""
, s AS (SELECT DISTINCT round(floor({_lat('c_custkey','c_custkey % 100')}/0.05)*0.05::DOUBLE+0.025,5) AS glat,
        round(floor({_lon('c_custkey','c_custkey % 100')}/0.05)*0.05::DOUBLE+0.025,5) AS glon FROM customer)
SELECT glat, glon, round({haversine('glat','glon','(-37.81)','144.96')},6) AS km FROM s""")
def snapped_registry_regions(t: Tables):
    k = F.col("c_custkey")
    lat, lon = hubs.snapped_center(lat_of(k, k % 100), lon_of(k, k % 100))
    s = t.table("customer").select(lat.alias("glat"), lon.alias("glon")).distinct()
    return s.withColumn("km", r6(grid.haversine_km(F.col("glat"), F.col("glon"), F.lit(-37.81), F.lit(144.96))))
