"""Fire life cycle, satellite grid, environment and summary queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberfield.functions import fire, time
from emberfield.operators import environment, fires, satellite
from emberfield.plans.bindings import Tables
from emberfield.plans.join_queries import CELLS_SQL, OVERLAY_SQL, _HIT, fires_x_grid, overlays
from emberfield.plans.registry import query, r6, rounded

# -- scalar rules -----------------------------------------------------------


@query("size_class", "SELECT size_class, count(*) AS n FROM fires GROUP BY 1", "fires")
def size_class(t: Tables):
    return t.fires.groupBy("size_class").agg(F.count(F.lit(1)).alias("n"))


@query("log_area", "SELECT fire_id, round(ln(1+area_ha),6) AS log_area FROM fires", "fires")
def log_area(t: Tables):
    return t.fires.select("fire_id", r6(fire.log_area(F.col("area_ha"))).alias("log_area"))


@query("kelvin_to_c", "SELECT event_id, round(brightness-273.15,6) AS celsius FROM hot", "hot")
def kelvin_to_c(t: Tables):
    return t.hot.select("event_id", r6(fire.kelvin_to_celsius(F.col("brightness"))).alias("celsius"))


@query("wind_speed", "SELECT l_orderkey, l_linenumber, round(sqrt(l_quantity*l_quantity+l_tax*l_tax),6) AS speed FROM lineitem")
def wind_speed(t: Tables):
    return t.table("lineitem").select("l_orderkey", "l_linenumber", r6(fire.wind_speed(F.col("l_quantity"), F.col("l_tax"))).alias("speed"))


@query("compass8", """
SELECT event_id, CASE (floor((k*3.7::DOUBLE)/45.0+0.5)::INT % 8) WHEN 0 THEN 'N' WHEN 1 THEN 'NE' WHEN 2 THEN 'E' WHEN 3 THEN 'SE' WHEN 4 THEN 'S'
 WHEN 5 THEN 'SW' WHEN 6 THEN 'W' ELSE 'NW' END AS dir FROM hot""", "hot")
def compass8(t: Tables):
    return t.hot.select("event_id", fire.compass8(F.col("k") * F.lit(3.7)).alias("dir"))


@query("modis_confidence_band", """
SELECT CASE WHEN c <= 30 THEN 'l' WHEN c >= 70 THEN 'h' WHEN c IS NOT NULL THEN 'n' END AS band, count(*) AS n
FROM (SELECT CASE WHEN event_id % 13 <> 0 THEN k END AS c FROM hot) GROUP BY 1""", "hot")
def modis_confidence_band(t: Tables):
    c = F.when(F.col("event_id") % 13 != 0, F.col("k"))
    return t.hot.groupBy(fire.modis_confidence_band(c).alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query("confidence_daynight_codes", """
SELECT CASE band WHEN 'l' THEN 1 WHEN 'n' THEN 2 WHEN 'h' THEN 3 END AS code, CASE daynight WHEN 'D' THEN 0 WHEN 'N' THEN 1 END AS dn, count(*) AS n
FROM hot GROUP BY 1,2""", "hot")
def confidence_daynight_codes(t: Tables):
    return t.hot.groupBy(fire.confidence_code(F.col("band")).alias("code"), fire.daynight_code(F.col("daynight")).alias("dn")).agg(
        F.count(F.lit(1)).alias("n"))


# -- life cycle -------------------------------------------------------------

@query("synthetic_fire_id", """
, f AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END AS fire_id FROM orders)
SELECT o_orderkey, coalesce(fire_id, -row_number() OVER (PARTITION BY fire_id IS NULL ORDER BY o_orderkey)) AS fire_id FROM f""")
def synthetic_fire_id(t: Tables):
    k = F.col("o_orderkey")
    return fires.synthetic_fire_ids(t.table("orders").select("o_orderkey", F.when(k % 5 != 0, k).alias("fire_id")), ["o_orderkey"])


_WINDOW = """
, kept AS (SELECT * FROM fire_det WHERE datetime >= ignition_date - INTERVAL 1 DAY AND datetime <= ignition_date + INTERVAL 120 DAY),
win AS (SELECT k.* FROM kept k JOIN (SELECT fire_id, min(datetime) AS fd FROM kept GROUP BY 1) USING (fire_id) WHERE fd <= ignition_date + INTERVAL 4 DAY),
gap AS (SELECT fire_id, datetime, lead(datetime) OVER (PARTITION BY fire_id ORDER BY datetime) AS nx FROM win),
ext AS (SELECT fire_id, min(datetime) AS extinguish_date FROM gap WHERE nx IS NULL OR nx - datetime > INTERVAL 4 DAY GROUP BY 1),
frp AS (SELECT fire_id, max(frp_peak) AS peak_frp, sum(frp_cumulative) AS cumulative_frp, count(*) AS dc FROM win GROUP BY 1)"""


@query("temporal_window_filter", _WINDOW + "SELECT fire_id, datetime, ignition_date, frp_peak FROM win", "fire_det")
def temporal_window_filter(t: Tables):
    return fires.temporal_window_filter(t.fire_det).select("fire_id", "datetime", "ignition_date", "frp_peak")


@query("first_detection_per_fire", "SELECT fire_id, datetime, min(datetime) OVER (PARTITION BY fire_id) AS first_detection FROM fire_det", "fire_det")
def first_detection_per_fire(t: Tables):
    return fires.first_detection_per_fire(t.fire_det).select("fire_id", "datetime", "first_detection")


@query("estimate_extinguish", _WINDOW + "SELECT fire_id, extinguish_date FROM ext", "fire_det")
def estimate_extinguish(t: Tables):
    return fires.estimate_extinguish(fires.temporal_window_filter(t.fire_det))


@query("fire_frp_severity", _WINDOW + "SELECT fire_id, peak_frp, round(cumulative_frp,6) AS cumulative_frp FROM fires LEFT JOIN frp USING (fire_id)", "fire_det fires")
def fire_frp_severity(t: Tables):
    sev = fires.fire_frp_severity(fires.temporal_window_filter(t.fire_det))
    return rounded(t.fires.select("fire_id").join(sev, "fire_id", "left"), "cumulative_frp")


@query("detection_count_status", _WINDOW + """
SELECT fire_id, coalesce(dc,0) AS viirs_detection_count, CASE WHEN coalesce(dc,0)=0 THEN 'never_detected' ELSE 'detected' END AS detection_status
FROM fires LEFT JOIN frp USING (fire_id)""", "fire_det fires")
def detection_count_status(t: Tables):
    return fires.detection_count_status(t.fires.select("fire_id"), fires.temporal_window_filter(t.fire_det))


UNIFIED = _WINDOW + """
, u0 AS (SELECT f.fire_id, ignition_date, area_ha, season, size_class, fire_type, lat, lon, half, peak_frp, cumulative_frp, coalesce(dc,0) AS viirs_detection_count,
   CASE WHEN extinguish_date < ignition_date THEN ignition_date + INTERVAL 6 HOUR ELSE extinguish_date END AS fend,
   CASE WHEN dc IS NOT NULL THEN 'detected' WHEN size_class IN ('small','medium') THEN 'imputed_same_day' WHEN size_class IN ('large','mega')
   THEN 'coverage_gap' ELSE 'never_detected' END AS detection_status
   FROM fires f LEFT JOIN frp USING (fire_id) LEFT JOIN ext USING (fire_id)),
uni AS (SELECT *, CASE WHEN detection_status = 'imputed_same_day' THEN ignition_date + INTERVAL 6 HOUR ELSE fend END AS extinguish_date,
   CASE WHEN detection_status = 'imputed_same_day' THEN 0.25::DOUBLE ELSE round(epoch(fend - ignition_date)/86400.0,2) END AS duration_days FROM u0)"""


@query("unify_fires", UNIFIED + """
SELECT fire_id, extinguish_date, duration_days, detection_status, viirs_detection_count, peak_frp, round(cumulative_frp,6) AS cumulative_frp FROM uni""", "fire_det fires")
def unify_fires(t: Tables):
    return rounded(fires.unify_fires(t.fires, t.fire_det), "cumulative_frp").select(
        "fire_id", "extinguish_date", "duration_days", "detection_status", "viirs_detection_count", "peak_frp", "cumulative_frp")


@query("duration_days", UNIFIED + "SELECT detection_status, round(avg(duration_days),6) AS mean_days, max(duration_days) AS longest, count(duration_days) AS n FROM uni GROUP BY 1", "fire_det fires")
def duration_days(t: Tables):
    return rounded(fires.unify_fires(t.fires, t.fire_det).groupBy("detection_status").agg(
        F.avg("duration_days").alias("mean_days"), F.max("duration_days").alias("longest"), F.count("duration_days").alias("n")), "mean_days")


@query("impute_undetected", UNIFIED + "SELECT detection_status, size_class, count(*) AS n FROM uni GROUP BY 1,2", "fire_det fires")
def impute_undetected(t: Tables):
    return fires.unify_fires(t.fires, t.fire_det).groupBy("detection_status", "size_class").agg(F.count(F.lit(1)).alias("n"))


_PAIRS = UNIFIED + CELLS_SQL.replace("WITH", "") + f"""
, pr AS (SELECT f.*, x::VARCHAR || '_' || y::VARCHAR AS cell_id FROM cb, uni f WHERE {_HIT}),
st AS (SELECT cell_id, count(DISTINCT fire_id) AS fire_count, round(round(sum(area_ha),6),2) AS total_area_burned_ha, round(max(peak_frp),2) AS max_peak_frp,
   round(round(coalesce(sum(cumulative_frp),0),6),2) AS total_cumulative_frp, round(round(avg(duration_days),6),2) AS avg_duration_days,
   count(*) FILTER (detection_status = 'detected') AS fires_detected, count(*) FILTER (detection_status IN ('imputed_same_day','coverage_gap')) AS fires_undetected
   FROM pr GROUP BY 1),
ds AS (SELECT cell_id, season AS dominant_season, row_number() OVER (PARTITION BY cell_id ORDER BY count(*) DESC, season) AS rn FROM pr GROUP BY 1,2),
gr AS (SELECT x::VARCHAR || '_' || y::VARCHAR AS cell_id, coalesce(fire_count,0) AS fire_count, coalesce(trunc(total_area_burned_ha),0)::BIGINT AS total_area_burned_ha,
   coalesce(trunc(max_peak_frp),0)::BIGINT AS max_peak_frp, coalesce(trunc(total_cumulative_frp),0)::BIGINT AS total_cumulative_frp,
   coalesce(fires_detected,0) AS fires_detected, coalesce(fires_undetected,0) AS fires_undetected,
   coalesce(dominant_season,'None') AS dominant_season, coalesce(avg_duration_days,0.0::DOUBLE) AS avg_duration_days
   FROM cc LEFT JOIN st ON st.cell_id = x::VARCHAR || '_' || y::VARCHAR LEFT JOIN ds ON ds.cell_id = st.cell_id AND ds.rn = 1)"""


def _pairs(t: Tables):
    uni = fires.unify_fires(t.fires, t.fire_det)
    pairs = fires_x_grid(t).select("fire_id", F.concat_ws("_", F.col("x").cast("string"), F.col("y").cast("string")).alias("cell_id"))
    return pairs.join(uni, "fire_id")


def _grid(t: Tables):
    from emberfield.plans.join_queries import cells_of

    cells = cells_of(t).select(F.concat_ws("_", F.col("x").cast("string"), F.col("y").cast("string")).alias("cell_id"))
    return fires.stats_onto_grid(cells, fires.cell_fire_stats(_pairs(t)))


@query("cell_fire_stats", _PAIRS + """
SELECT st.*, dominant_season FROM st JOIN ds ON ds.cell_id = st.cell_id AND rn = 1""", "fire_det fires hot")
def cell_fire_stats(t: Tables):
    return fires.cell_fire_stats(_pairs(t))


@query("cell_fire_stats_share", UNIFIED + OVERLAY_SQL.replace("WITH", "") + """
SELECT x::VARCHAR || '_' || y::VARCHAR AS cell_id, count(DISTINCT fire_id) AS fire_count, round(round(sum(area_ha*area/of_area),6),2) AS total_area_burned_ha, round(max(peak_frp),2) AS max_peak_frp
FROM ov JOIN uni USING (fire_id) GROUP BY 1""", "fire_det fires hot")
def cell_fire_stats_share(t: Tables):
    """Each fire counts with the part of its area in the cell."""
    pairs = overlays(t).withColumn("cell_id", F.concat_ws("_", F.col("x").cast("string"), F.col("y").cast("string")))
    stats = fires.cell_fire_stats(pairs.join(fires.unify_fires(t.fires, t.fire_det), "fire_id"), area="share")
    return stats.select("cell_id", "fire_count", "total_area_burned_ha", "max_peak_frp")


@query("stats_onto_grid", _PAIRS + "SELECT * FROM gr", "fire_det fires hot")
def stats_onto_grid(t: Tables):
    return _grid(t)


@query("stats_onto_grid_uncut", _PAIRS + """
SELECT gr.cell_id, coalesce(st.total_area_burned_ha, 0) AS total_area_burned_ha, coalesce(st.max_peak_frp, 0) AS max_peak_frp,
  coalesce(st.total_cumulative_frp, 0) AS total_cumulative_frp FROM gr LEFT JOIN st ON st.cell_id = gr.cell_id""", "fire_det fires hot")
def stats_onto_grid_uncut(t: Tables):
    from emberfield.plans.join_queries import cells_of

    cells = cells_of(t).select(F.concat_ws("_", F.col("x").cast("string"), F.col("y").cast("string")).alias("cell_id"))
    whole = fires.stats_onto_grid(cells, fires.cell_fire_stats(_pairs(t)), cut=False)
    return whole.select("cell_id", "total_area_burned_ha", "max_peak_frp", "total_cumulative_frp")


@query("grid_fire_summary", _PAIRS + """
SELECT count(*) AS cells, count(*) FILTER (fire_count > 0) AS cells_with_fires, sum(fire_count)::BIGINT AS total_fires,
 sum(total_area_burned_ha)::BIGINT AS total_area_ha, round(sum(fire_count)/count(*) FILTER (fire_count > 0),6) AS fires_per_burnt_cell,
 sum(fires_detected)::BIGINT AS detected, sum(fires_undetected)::BIGINT AS undetected FROM gr""", "fire_det fires hot")
def grid_fire_summary(t: Tables):
    return rounded(fires.grid_fire_summary(_grid(t)), "fires_per_burnt_cell")


@query("top_n", _PAIRS + "SELECT cell_id, fire_count, total_area_burned_ha FROM gr ORDER BY fire_count DESC, cell_id LIMIT 10", "fire_det fires hot")
def top_n(t: Tables):
    return fires.top_cells(_grid(t))


@query("season_counts", _PAIRS + "SELECT dominant_season, count(*) AS cells FROM gr WHERE dominant_season <> 'None' GROUP BY 1", "fire_det fires hot")
def season_counts(t: Tables):
    return fires.season_counts(_grid(t))


@query("fire_history_features", _PAIRS + """
, pa AS (SELECT * FROM pr WHERE ignition_date <= TIMESTAMP '2000-06-30')
SELECT cell_id, count(DISTINCT fire_id) AS fire_frequency, round((DATE '2000-06-30' - max(ignition_date)::DATE)/365.25,6) AS years_since_last_fire,
 arg_max(area_ha, (ignition_date, fire_id)) AS last_area_ha, arg_max(coalesce(peak_frp,-1), (ignition_date, fire_id)) AS last_severity FROM pa GROUP BY 1""", "fire_det fires hot")
def fire_history_features(t: Tables):
    out = fires.fire_history_features(_pairs(t), F.lit("2000-06-30").cast(time.NTZ))
    return rounded(out, "years_since_last_fire").withColumn("last_severity", F.coalesce("last_severity", F.lit(-1.0)))


@query("detections_daily_cell", """
, d AS (SELECT *, row_number() OVER (PARTITION BY cell_x, cell_y, acq_date, daynight ORDER BY event_id) AS rn FROM hot)
SELECT cell_x, cell_y, daynight, max(frp) AS frp, max(brightness) AS brightness, arg_min(lat, rn) AS lat, arg_min(bright_t31, rn) FILTER (bright_t31 IS NOT NULL) AS bright_t31,
 acq_date::TIMESTAMP AS datetime FROM d GROUP BY cell_x, cell_y, acq_date, daynight""", "hot")
def detections_daily_cell(t: Tables):
    src = t.hot.withColumn("datetime", F.col("ts"))
    return fires.detections_daily_cell(src, ["frp", "brightness"], ["lat", "bright_t31"], ["event_id"])


# -- satellite grid ---------------------------------------------------------

def _detections(t: Tables):
    return t.hot.withColumns({"confidence": F.col("band"), "grid_id": F.col("cell_y") * 1000000 + F.col("cell_x")})


_SAT = """
, g AS (SELECT cell_y*1000000+cell_x AS grid_id, cell_x, cell_y, acq_date, daynight, satellite, max(brightness) AS brightness, max(bright_t31) AS bright_t31,
  max(frp) AS frp_peak, sum(frp) AS frp_cumulative, max(CASE band WHEN 'l' THEN 1 WHEN 'n' THEN 2 ELSE 3 END) AS confidence, max(acq_time) AS acq_time
  FROM hot GROUP BY 1,2,3,4,5,6),
p0 AS (SELECT *, acq_date::TIMESTAMP + to_hours(substr(acq_time,1,2)::INT) + to_minutes(substr(acq_time,3,2)::INT) AS datetime FROM g),
p AS (SELECT *, min(datetime) OVER (PARTITION BY satellite, acq_date, daynight) AS pass_datetime FROM p0),
ps AS (SELECT pass_datetime, satellite, lag(pass_datetime) OVER (ORDER BY pass_datetime, satellite) AS prev FROM (SELECT DISTINCT pass_datetime, satellite FROM p)),
pd AS (SELECT pass_datetime, lag(pass_datetime) OVER (ORDER BY pass_datetime) AS before FROM (SELECT DISTINCT pass_datetime FROM p))"""


@query("grid_pass_agg", _SAT + "SELECT grid_id, cell_x, cell_y, acq_date, daynight, satellite, brightness, bright_t31, frp_peak, round(frp_cumulative,6) AS frp_cumulative, confidence, acq_time FROM g", "hot")
def grid_pass_agg(t: Tables):
    return rounded(satellite.grid_pass_agg(_detections(t)), "frp_cumulative")


def _passes(t: Tables):
    return satellite.pass_datetime(satellite.grid_pass_agg(_detections(t)))


@query("pass_datetime", _SAT + "SELECT cell_x, cell_y, satellite, datetime, pass_datetime FROM p", "hot")
def pass_datetime(t: Tables):
    return _passes(t).select("cell_x", "cell_y", "satellite", "datetime", "pass_datetime")


@query("time_since_prev_pass", _SAT + """
SELECT cell_x, cell_y, satellite, pass_datetime, coalesce(epoch(pass_datetime - prev),0)::DOUBLE AS time_since_prev_pass FROM p JOIN ps USING (pass_datetime, satellite)""", "hot")
def time_since_prev_pass(t: Tables):
    return satellite.time_since_prev_pass(_passes(t)).select("cell_x", "cell_y", "satellite", "pass_datetime", "time_since_prev_pass")


@query("time_since_prev_pass_per_satellite", _SAT + """
, own AS (SELECT pass_datetime, satellite, lag(pass_datetime) OVER (PARTITION BY satellite ORDER BY pass_datetime) AS mine FROM ps)
SELECT cell_x, cell_y, satellite, pass_datetime, coalesce(epoch(pass_datetime - mine),0)::DOUBLE AS time_since_prev_pass FROM p JOIN own USING (pass_datetime, satellite)""", "hot")
def time_since_prev_pass_per_satellite(t: Tables):
    return satellite.time_since_prev_pass(_passes(t), per_satellite=True).select("cell_x", "cell_y", "satellite", "pass_datetime", "time_since_prev_pass")


def _neigh(alias: str, table: str, r: int) -> str:
    return (f"(SELECT count(*) FROM p {alias} WHERE {alias}.pass_datetime = {table} AND abs({alias}.cell_x-p.cell_x) <= {r} "
            f"AND abs({alias}.cell_y-p.cell_y) <= {r})")


@query("burning_neighbors", _SAT + f"""
SELECT p.cell_x, p.cell_y, p.satellite, p.pass_datetime, {_neigh('a', 'p.pass_datetime', 1)} - 1 AS burning_neighbors_r1,
 {_neigh('b', 'p.pass_datetime', 2)} - 1 AS burning_neighbors_r2 FROM p""", "hot")
def burning_neighbors(t: Tables):
    out = satellite.burning_neighbors(_passes(t).withColumn("is_burning", F.lit(1)))
    return out.select("cell_x", "cell_y", "satellite", "pass_datetime", "burning_neighbors_r1", "burning_neighbors_r2")


@query("prev_burning_neighbors", _SAT + f"""
SELECT p.cell_x, p.cell_y, p.satellite, p.pass_datetime, {_neigh('a', 'pd.before', 1)} AS burning_neighbors_prev_r1,
 {_neigh('b', 'pd.before', 2)} AS burning_neighbors_prev_r2 FROM p JOIN pd USING (pass_datetime)""", "hot")
def prev_burning_neighbors(t: Tables):
    out = satellite.burning_neighbors(_passes(t).withColumn("is_burning", F.lit(1)))
    return out.select("cell_x", "cell_y", "satellite", "pass_datetime", "burning_neighbors_prev_r1", "burning_neighbors_prev_r2")


_W5 = "OVER (PARTITION BY cell_x, cell_y ORDER BY pass_datetime, satellite)"


@query("cell_lag_lead", _SAT + f"""
SELECT cell_x, cell_y, satellite, pass_datetime, CASE WHEN lag(1) {_W5} IS NULL THEN 0 ELSE 1 END AS is_burning_prev, coalesce(lag(frp_peak) {_W5},0.0::DOUBLE) AS frp_prev,
 CASE WHEN lead(1) {_W5} IS NULL THEN 0 ELSE 1 END AS is_burning_next, coalesce(lead(frp_peak) {_W5},0.0::DOUBLE) AS frp_next FROM p""", "hot")
def cell_lag_lead(t: Tables):
    out = satellite.cell_lag_lead(_passes(t).withColumn("is_burning", F.lit(1)))
    return out.select("cell_x", "cell_y", "satellite", "pass_datetime", "is_burning_prev", "frp_prev", "is_burning_next", "frp_next")


@query("gridded_satellite_table", _SAT + f"""
, ll AS (SELECT *, coalesce(lag(frp_peak) {_W5},0.0::DOUBLE) AS frp_prev, coalesce(lead(frp_peak) {_W5},0.0::DOUBLE) AS frp_next FROM p)
SELECT daynight_code AS daynight, count(*) AS n, sum(n2)::BIGINT AS neighbors, round(sum(frp_prev),4) AS frp_prev, round(sum(frp_next),4) AS frp_next
FROM (SELECT CASE daynight WHEN 'D' THEN 0 ELSE 1 END AS daynight_code, frp_prev, frp_next,
  (SELECT count(*) FROM p a WHERE a.pass_datetime = ll.pass_datetime AND abs(a.cell_x-ll.cell_x) <= 2 AND abs(a.cell_y-ll.cell_y) <= 2) - 1 AS n2 FROM ll) GROUP BY 1""", "hot")
def gridded_satellite_table(t: Tables):
    out = satellite.gridded_satellite_table(_detections(t))
    return out.groupBy("daynight").agg(
        F.count(F.lit(1)).alias("n"), F.sum("burning_neighbors_r2").cast("bigint").alias("neighbors"),
        F.round(F.sum("frp_prev"), 4).alias("frp_prev"), F.round(F.sum("frp_next"), 4).alias("frp_next"))


@query("combine_satellites", """
SELECT satellite, CASE WHEN satellite = 'click' THEN CASE WHEN k <= 30 THEN 'l' WHEN k >= 70 THEN 'h' ELSE 'n' END ELSE band END AS confidence, count(*) AS n
FROM hot GROUP BY 1,2""", "hot")
def combine_satellites(t: Tables):
    """All five kinds of events as three archives."""
    def product(*names: str):
        return t.hot.where(F.col("satellite").isin(*names)).select("satellite", F.col("band").alias("confidence"))

    modis = t.hot.where("satellite = 'click'").select("satellite", F.col("k").alias("confidence"))
    return satellite.combine_satellites([product("view", "purchase"), product("signup", "error")], modis).groupBy("satellite", "confidence").agg(
        F.count(F.lit(1)).alias("n"))


# -- environment and summaries ----------------------------------------------

@query("env_12h_mean", """
, b AS (SELECT date_trunc('day', min(ts)) AS s, date_trunc('hour', max(ts)) AS e FROM hot),
q AS (SELECT cell_x, floor(epoch(ts - s)/43200.0)::BIGINT AS i, s, e, avg(frp) AS frp, avg(bright_t31) AS bright_t31 FROM hot, b WHERE ts < e GROUP BY ALL)
SELECT cell_x, round(frp,6) AS frp, round(bright_t31,6) AS bright_t31, s + to_hours((i*12)::INT) AS interval_start, s + to_hours(((i+1)*12)::INT) AS interval_end
FROM q WHERE s + to_hours(((i+1)*12)::INT) <= e""", "hot")
def env_12h_mean(t: Tables):
    b = t.hot.agg(F.struct(time.floor_day(F.min("ts")).alias("s"), time.floor_hour(F.max("ts")).alias("e"))).scalar()

    # the bounds become two literals of the plan through one scalar subquery
    lo, hi = b.getField("s"), b.getField("e")
    out = environment.env_12h_mean(t.hot, ["cell_x"], "ts", ["frp", "bright_t31"], lo, hi)
    return rounded(out, "frp", "bright_t31")


@query("cell_region_mean", "SELECT cell_x, cell_y, acq_date, round(avg(frp),6) AS frp FROM hot GROUP BY 1,2,3", "hot")
def cell_region_mean(t: Tables):
    return rounded(environment.cell_region_mean(t.hot, ["cell_x", "cell_y"], "acq_date", ["frp"]), "frp")


@query("monthly_mean_temperature", "SELECT date_trunc('month', ts) AS month, round(avg(quantity),6) AS mean_quantity FROM obs GROUP BY 1", "obs")
def monthly_mean_temperature(t: Tables):
    return rounded(environment.monthly_mean(t.obs, "ts", "quantity"), "mean_quantity")


@query("monthly_incident_count", "SELECT date_trunc('month', ignition_date) AS month, count(*) AS incidents FROM fires GROUP BY 1", "fires")
def monthly_incident_count(t: Tables):
    return environment.monthly_count(t.fires, "ignition_date")


@query("confidence_histogram", """
, l AS (SELECT min(k) AS lo, max(k) AS hi FROM hot),
c AS (SELECT least(floor((k-lo)/((hi-lo)/20.0::DOUBLE)),19)::INT AS bin, count(*) AS n FROM hot, l GROUP BY 1)
SELECT b.bin::INT AS bin, coalesce(n,0) AS n FROM range(0,20) b(bin) LEFT JOIN c ON c.bin = b.bin""", "hot")
def confidence_histogram(t: Tables):
    return environment.histogram(t.hot, "k", 20)


@query("describe", """
SELECT 'count' AS statistic, count(frp)::DOUBLE AS value FROM hot UNION ALL SELECT 'mean', round(avg(frp),6) FROM hot UNION ALL SELECT 'std', round(stddev_samp(frp),6) FROM hot
UNION ALL SELECT 'min', min(frp) FROM hot UNION ALL SELECT 'max', max(frp) FROM hot UNION ALL SELECT '25%', round(quantile_cont(frp,0.25),6) FROM hot
UNION ALL SELECT '50%', round(quantile_cont(frp,0.5),6) FROM hot UNION ALL SELECT '75%', round(quantile_cont(frp,0.75),6) FROM hot""", "hot")
def describe(t: Tables):
    return rounded(environment.describe(t.hot, "frp"), "value")


@query("soil_moisture_by_time", """
SELECT ts, round(avg(discount)+1e-9,6) AS surface_mean, round(avg(tax)+1e-9,6) AS rootzone_mean, min(discount) AS surface_min, max(discount) AS surface_max,
 min(tax) AS rootzone_min, max(tax) AS rootzone_max FROM obs GROUP BY 1""", "obs")
def soil_moisture_by_time(t: Tables):
    out = environment.soil_moisture_by_time(t.obs, "ts", "discount", "tax")
    means = {c: F.col(c) + 1e-9 for c in ("surface_mean", "rootzone_mean")}  # sums in another order must not flip a tie
    return rounded(out.withColumns(means), *means)


@query("postcode_weather", "SELECT c_nationkey AS postcode, round(avg(c_acctbal),6) AS c_acctbal FROM customer GROUP BY 1")
def postcode_weather(t: Tables):
    return rounded(environment.group_mean(t.table("customer").withColumnRenamed("c_nationkey", "postcode"), "postcode", ["c_acctbal"]), "c_acctbal")


_ENSO_IN = "['DJF','JFM','FMA','MAM','AMJ','MJJ','JJA','JAS','ASO','SON','OND','NDJ']"


@query("enso_lag6", f"""
, m AS (SELECT year(o_orderdate) AS yr, month(o_orderdate) AS mo, round(sum(o_totalprice)/1e6,6) AS anom FROM orders GROUP BY 1,2)
SELECT yr::VARCHAR || '-' || lpad(mo::VARCHAR,2,'0') AS record_year_month, make_timestamp(yr,mo,1,0,0,0) AS datetime_record, (yr*100+mo)*10000+100 AS time_id,
 anom AS oni_anomaly, CASE WHEN anom >= 0.5 THEN 'El Nino' WHEN anom <= -0.5 THEN 'La Nina' ELSE 'Neutral' END AS enso_phase,
 lag(anom,6) OVER (ORDER BY mo, yr) AS oni_lag6m FROM m""")
def enso_lag6(t: Tables):
    """Monthly totals as the index, in a file ordered by month then year: the lag follows the file."""
    codes = F.array(*[F.lit(c) for c in time.ENSO_SEASONS])
    m = t.table("orders").groupBy(F.year("o_orderdate").alias("YR"), F.month("o_orderdate").alias("mo")).agg(
        F.round(F.sum("o_totalprice") / 1e6, 6).alias("ANOM"))
    src = m.withColumns({"SEAS": F.get(codes, F.col("mo") - 1), "l1": F.col("mo"), "l2": F.col("YR")}).drop("mo")
    return environment.enso_table(src, ["l1", "l2"])


@query("weather_strip", """
SELECT CASE WHEN hour(ts) = 9 THEN 'NOW' ELSE strftime(ts,'%H:%M') END AS "time", floor(frp+0.5)::BIGINT::VARCHAR || '°C' AS temp, hour(ts) = 9 AS now, frp < 38 AS amber, event_id
FROM hot WHERE acq_date = DATE '2024-01-15' AND hour(ts) BETWEEN 9 AND 14""", "hot")
def weather_strip(t: Tables):
    src = t.hot.select("event_id", "ts", F.col("frp").alias("temperature"), F.col("brightness").alias("wind_speed"), (F.col("k") * F.lit(3.7)).alias("wind_direction"))
    out = environment.weather_strip(src, "ts", F.lit("2024-01-15 09:30:00").cast(time.NTZ))
    return out.join(src.select("ts", "event_id"), "ts").select("time", "temp", "now", "amber", "event_id")
