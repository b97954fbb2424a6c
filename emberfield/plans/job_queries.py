"""Whole jobs as registered queries, on files that Spark derives from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberfield.functions import time
from emberfield.operators import scaling
from emberfield.plans import jobs
from emberfield.plans.bindings import Tables, diamond
from emberfield.plans.registry import query, rounded
from emberfield.session import scratch_path
from emberfield.sources import sinks


@query("job_hub_and_spoke", """
, spokes AS (SELECT unnest(['fire', 'weather', 'vegetation', 'topography', 'infrastructure']) AS name),
all_of AS (SELECT name, k, satellite FROM hot, spokes), inside AS (SELECT name, k, satellite FROM hot_in, spokes)
SELECT 'input' AS kind, name, count(*) AS rows FROM all_of WHERE CASE name WHEN 'vegetation' THEN k % 2 = 0 WHEN 'infrastructure' THEN satellite = 'click' ELSE true END GROUP BY name
UNION ALL SELECT 'output', name, count(*) FROM inside WHERE CASE name WHEN 'vegetation' THEN k % 2 = 0 WHEN 'infrastructure' THEN satellite = 'click' ELSE true END GROUP BY name
UNION ALL SELECT 'registry', 'location_ids', count(*) FROM loc UNION ALL SELECT 'registry', 'time_ids', count(*) FROM tim""", "loc tim")
def job_hub_and_spoke(t: Tables):
    """All five spokes, each a file derived from the detections: three with times, two without."""
    source, target = scratch_path(t.spark, "job-in"), scratch_path(t.spark, "job-out")
    place = [F.col("lat").alias("original_latitude"), F.col("lon").alias("original_longitude")]
    k, stamp, origin = F.col("k").cast("double"), F.col("ts").alias("datetime_record"), F.col("satellite").alias("source_system")
    spokes = {
        "fire": t.hot.select(F.col("event_id").alias("incident_id"), *place, k.alias("confidence_score"), origin, stamp),
        "weather": t.hot.select(F.col("event_id").alias("weather_id"), *place, k.alias("temperature_c"), k.alias("wind_speed_kmh"), k.alias("relative_humidity"), origin, stamp),
        "vegetation": t.hot.where("k % 2 = 0").select(
            F.col("event_id").alias("veg_condition_id"), *place, (k / 10).alias("dryness_index"), (k / 100).alias("soil_moisture"), F.col("band").alias("vegetation_class"), origin, stamp),
        "topography": t.hot.select(F.col("event_id").alias("topo_id"), *place, (k * 10).alias("elevation_m"), k.alias("slope_angle")),
        "infrastructure": t.hot.where("satellite = 'click'").select(
            F.col("event_id").alias("asset_id"), *place, F.concat(F.lit("asset "), F.col("event_id")).alias("facility_name"), F.col("band").alias("risk_category")),
    }
    for name, rows in spokes.items():
        sinks.write_csv(rows, f"{source}/{name}_sample.csv")
    return jobs.load_hub_and_spoke(t.spark, source, target).withColumn("rows", F.col("rows").cast("bigint"))


_R = "6378137.0::DOUBLE"
_MERCATOR = f"""
, m AS (SELECT *, floor((radians(lon)*{_R} - 15640000.0)/5000.0)::BIGINT AS mx, floor((ln(tan(pi()/4+radians(lat)/2))*{_R} + 4810000.0)/5000.0)::BIGINT AS my
  FROM hot, (SELECT round(avg(lat),2) AS blat, round(avg(lon),2) AS blon FROM hot) WHERE abs(lon-blon)+abs(lat-blat) < 2.5)"""


def _history(t: Tables):
    b = t.hot.agg(F.round(F.avg("lat"), 2).alias("lat"), F.round(F.avg("lon"), 2).alias("lon"))
    boundary = b.select(diamond(F.col("lon"), F.col("lat"), F.lit(2.5)).alias("rings"))
    raw = t.hot.select(F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), "acq_date", "acq_time", "satellite", "daynight",
                       F.col("band").alias("confidence"), "brightness", "bright_t31", "frp")
    return jobs.satellite_history(raw, boundary, (15641234.0, -4809000.0))


@query("job_satellite_history", _MERCATOR + """
SELECT satellite, CASE daynight WHEN 'D' THEN 0 ELSE 1 END AS daynight, count(DISTINCT (mx, my, acq_date)) AS passes, count(DISTINCT (mx, my)) AS cells, round(sum(frp),4) AS frp, true AS centres_in_cells FROM m GROUP BY 1,2""", "hot")
def job_satellite_history(t: Tables):
    """Detections inside the boundary, gridded; every clipped cell's centre lies in its cell."""
    x, y = F.radians("longitude") * 6378137.0, F.log(F.tan(F.lit(0.7853981633974483) + F.radians("latitude") / 2)) * 6378137.0
    inside = F.abs((x - 15640000.0) / 5000.0 - F.col("cell_x") - 0.5).between(0, 0.5) & F.abs((y + 4810000.0) / 5000.0 - F.col("cell_y") - 0.5).between(0, 0.5)
    return _history(t).groupBy("satellite", "daynight").agg(
        F.count(F.lit(1)).alias("passes"), F.countDistinct("cell_x", "cell_y").alias("cells"), F.round(F.sum("frp_cumulative"), 4).alias("frp"), F.every(inside).alias("centres_in_cells"))


@query("job_unified_fires", _MERCATOR + f"""
, c AS (SELECT DISTINCT mx, my, degrees((mx*5000+15640000.0)/{_R}) AS w, degrees(((mx+1)*5000+15640000.0)/{_R}) AS e,
  degrees(2*atan(exp((my*5000-4810000.0)/{_R}))-pi()/2) AS s, degrees(2*atan(exp(((my+1)*5000-4810000.0)/{_R}))-pi()/2) AS n FROM m),
h AS (SELECT DISTINCT mx, my FROM c, fires f WHERE greatest(w-f.lon, f.lon-e, 0)+greatest(s-f.lat, f.lat-n, 0) <= f.half)
SELECT (SELECT count(*) FROM fires) AS fires, (SELECT count(*) FROM h) AS cells, (SELECT count(DISTINCT (mx, my, acq_date, daynight)) FROM m JOIN h USING (mx, my)) AS cell_days""", "hot fires")
def job_unified_fires(t: Tables):
    """Fires against the squares of the gridded table: every fire once, and the cells and half-days inside fires."""
    unified, daily = jobs.unified_fire_history(t.fire_shapes, _history(t), (15641234.0, -4809000.0))
    days = daily.agg(F.countDistinct("cell_x", "cell_y").alias("cells"), F.count(F.lit(1)).alias("cell_days"))
    return unified.agg(F.count(F.lit(1)).alias("fires")).join(days, F.lit(True))


@query("job_risk_map", """
, x AS (SELECT max(quantity) AS hi, min(quantity) AS lo FROM obs),
r AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY ts DESC) AS rn FROM obs),
p AS (SELECT location_id, avg((quantity-lo)/(hi-lo)) AS p FROM r, x, registry WHERE rn <= 30 AND cell % 1500 + 1 = location_id GROUP BY 1)
SELECT count(*) AS cells, count(*) FILTER (p IS NULL) AS unknown FROM p""", "obs registry")
def job_risk_map(t: Tables):
    """Scaled sequences of all cells, scored, as a contract-checked map written to its snapshot."""
    from emberfield.operators.ordering import number_rows

    times = number_rows(t.obs.select(F.col("ts").alias("datetime_record")).distinct(), ["datetime_record"], "time_id")
    weather = t.obs.withColumn("location_id", F.col("cell") % 1500 + 1).join(times.withColumnRenamed("datetime_record", "ts"), "ts")
    target = scratch_path(t.spark, "risk-map")
    jobs.forecast_risk_map(weather, t.registry, times, ["quantity"], scaling.fit_scaler(t.obs, ["quantity"]), lambda block: block.mean(axis=1), 30, target)
    written = t.spark.read.parquet(target)
    return written.agg(F.count(F.lit(1)).alias("cells"), F.count_if(F.col("risk_factor").isNull()).alias("unknown"))


_SPLIT = "CASE WHEN s.dt < TIMESTAMP '1999-01-01' THEN 'train' WHEN s.dt <= TIMESTAMP '1999-06-30' THEN 'val' WHEN s.dt >= TIMESTAMP '1999-07-01' THEN 'test' END"


@query("job_training_samples", f"""
, e AS (SELECT 1 + cell % 20 AS cx, (cell // 20) % 12 AS cy, ts + to_hours((cell % 2 * 12)::INT) AS dt, quantity AS q, price AS pr FROM obs WHERE cell % 19 <> 0),
s AS (SELECT cx, cy, dt, q, min(pr) AS pr FROM e JOIN (SELECT cx, cy, dt, min(q) AS q FROM e GROUP BY 1, 2, 3) USING (cx, cy, dt, q) GROUP BY 1, 2, 3, 4),
f AS (SELECT DISTINCT floor((lon-139.9997)/0.5)::BIGINT AS cx, floor((lat+40.0003)/0.5)::BIGINT AS cy, ignition_date + to_hours((fire_id % 2 * 12)::INT) AS dt FROM fires WHERE fire_type <> 'Unknown'),
l AS (SELECT s.*, CASE WHEN f.cx IS NULL THEN 0 ELSE 1 END AS y, {_SPLIT} AS split FROM s LEFT JOIN f ON f.cx = s.cx AND f.cy = s.cy AND f.dt = s.dt),
r AS (SELECT *, row_number() OVER w - 1 AS idx, count(*) OVER (PARTITION BY split, cx, cy) AS n,
  sum(q) OVER (w ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS sq, lag(pr) OVER w AS last_pr FROM l WHERE split IS NOT NULL WINDOW w AS (PARTITION BY split, cx, cy ORDER BY dt)),
k AS (SELECT avg(q) AS mq, stddev_pop(q) AS dq, avg(pr) AS mp, stddev_pop(pr) AS dp FROM r WHERE split = 'train' AND n > 60),
a AS (SELECT *, row_number() OVER (PARTITION BY split, y ORDER BY (datediff('day', DATE '1970-01-01', dt::DATE)*7919 + cx*31 + cy*17) % 1000003, cx, cy, dt) AS rn,
  sum(y) OVER (PARTITION BY split) AS pos FROM r WHERE idx >= 60)
SELECT split, cx AS cell_x, cy AS cell_y, idx AS anchor, y AS is_burning, round((sq-60*mq)/dq,4) AS sum_q, round((last_pr-mp)/dp,4) AS last_price FROM a, k WHERE y = 1 OR rn <= 20*pos""", "obs fires")
def job_training_samples(t: Tables):
    """Sequences for a classifier: cells of suppliers, outlines of fires; every 19th supplier lacks a feature, several may report one cell."""
    c = F.col("cell")
    env = t.obs.select((1 + c % 20).alias("cell_x"), (F.floor(c / 20) % 12).alias("cell_y"), time.half_day(F.col("ts"), c % 2).alias("datetime"),
                       "quantity", F.when(c % 19 != 0, F.col("price")).alias("price"))
    burnt = t.fire_shapes.where("fire_type <> 'Unknown'").select("rings", F.col("ignition_date").alias("date"), (F.col("fire_id") % 2).alias("daynight"), F.lit(1).alias("is_burning"))
    day = F.datediff(F.to_date("datetime"), F.lit("1970-01-01").cast("date")).cast("bigint")
    samples, _ = jobs.training_samples(
        env, burnt, ["quantity", "price"], (0.5, (139.9997, -40.0003)), scratch_path(t.spark, "samples"), 60, 20, ("1999-01-01", "1999-06-30", "1999-07-01"),
        order=[(day * 7919 + F.col("cell_x") * 31 + F.col("cell_y") * 17) % 1000003])
    total = F.aggregate(F.transform("x", lambda o: o[0]), F.lit(0.0), lambda a, v: a + v)
    return samples.select("split", "cell_x", "cell_y", F.col("anchor").cast("bigint").alias("anchor"), "is_burning", F.round(total, 4).alias("sum_q"),
                          F.round(F.get(F.get("x", F.lit(59)), F.lit(1)), 4).alias("last_price"))


@query("job_evaluation", """
, a AS (SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS t_idx, count(*) OVER () AS n FROM (SELECT DISTINCT ts FROM obs)),
d AS (SELECT is_burning AS y, quantity/51.0::DOUBLE AS p, CASE WHEN t_idx < floor(floor(n*0.9::DOUBLE)*0.85::DOUBLE) THEN 'train' WHEN t_idx < floor(n*0.9::DOUBLE) THEN 'val' ELSE 'test' END AS split
  FROM obs JOIN a USING (ts) WHERE cell % 7 <> 0),
s AS (SELECT split, p, count(*) AS n, sum(y) AS pos FROM d GROUP BY 1,2),
c AS (SELECT *, sum(n) OVER (PARTITION BY split ORDER BY p DESC) AS cn, sum(pos) OVER (PARTITION BY split ORDER BY p DESC) AS cp, sum(n) OVER (PARTITION BY split) AS tn, sum(pos) OVER (PARTITION BY split) AS tp FROM s),
th AS (SELECT arg_max(p, (5*(cp/cn)*(cp/tp)/(4*(cp/cn)+(cp/tp)+1e-12), -p)) AS t FROM c WHERE split = 'val'),
r AS (SELECT sum(pos/tp*(cp/cn)) AS ap, sum((n-pos)*(cp-pos/2.0::DOUBLE)/tp/(tn-tp)) AS auc FROM c WHERE split = 'test'),
k AS (SELECT count(*) AS n, sum(y)::BIGINT AS np, count(*) FILTER (p>=t AND y=1) AS tp, count(*) FILTER (p>=t AND y=0) AS fp, count(*) FILTER (p<t AND y=1) AS fn, count(*) FILTER (p<t AND y=0) AS tn,
  avg((p-y)*(p-y)) AS brier, max(t) AS t FROM d, th WHERE split = 'test'),
m AS (SELECT *, tp/(tp+fp) AS pr, tp/(tp+fn) AS rc, np/n AS b FROM k)
SELECT n AS n_cells, np AS n_positive, round(t,6) AS threshold, tp, fp, fn, tn, round(brier,6) AS brier, round(pr,6) AS precision, round(rc,6) AS recall, round(5*pr*rc/(4*pr+rc),6) AS f2,
  round(ap,6) AS pr_auc, round(auc,6) AS roc_auc, round(b,6) AS base_rate, round(5*b/(4*b+1+1e-12),6) AS always_positive_f2 FROM m, r""", "obs")
def job_evaluation(t: Tables):
    """A forecast of all cells and times against its labels; every seventh cell has no input and does not count."""
    cell = [(F.col("cell") % 10).alias("cell_x"), F.floor(F.col("cell") / 10).alias("cell_y")]
    out = jobs.evaluate_forecast(
        t.obs.select(*cell, "ts", (F.col("quantity") / 51.0).alias("p")), t.obs.select(*cell, "ts", "is_burning"),
        t.obs.select(*cell, F.when(F.col("cell") % 7 != 0, F.col("price")).alias("price")), "ts", ["cell_x", "cell_y"], ["price"])
    scores = ["threshold", "brier", "precision", "recall", "f2", "pr_auc", "roc_auc", "base_rate", "always_positive_f2"]
    return rounded(out, *scores).select("n_cells", "n_positive", "tp", "fp", "fn", "tn", *scores)
