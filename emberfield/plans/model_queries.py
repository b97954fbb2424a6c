"""Sequences, samples, splits, scaling, risk bands and evaluation metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberfield.functions import fire, grid, time
from emberfield.operators import metrics, scaling, scoring, sequences, splits
from emberfield.plans.bindings import Tables
from emberfield.plans.registry import query, r6, rounded

FEATURES = ["quantity", "price", "discount", "tax"]

# -- series -----------------------------------------------------------------

_GAPPED = """
, g AS (SELECT cell, ts, CASE WHEN (cell + day(ts)) % 3 = 0 THEN quantity END AS q, row_number() OVER (PARTITION BY cell ORDER BY ts) AS i FROM obs),
c AS (SELECT *, max(CASE WHEN q IS NOT NULL THEN i END) OVER (PARTITION BY cell ORDER BY i) AS ia,
      min(CASE WHEN q IS NOT NULL THEN i END) OVER (PARTITION BY cell ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ib FROM g),
f AS (SELECT c.cell, c.ts, c.ia, c.ib, c.i, a.q AS qa, b.q AS qb FROM c LEFT JOIN g a ON a.cell=c.cell AND a.i=c.ia LEFT JOIN g b ON b.cell=c.cell AND b.i=c.ib)"""


def _gapped(t: Tables):
    keep = (F.col("cell") + F.dayofmonth("ts")) % 3 == 0
    return t.obs.select("cell", "ts", F.when(keep, F.col("quantity")).alias("q"))


for _dir, _lead, _tail in (("forward", "NULL", "qa"), ("backward", "qb", "NULL"), ("both", "qb", "qa")):
    @query(f"interpolate_time_series_{_dir}", _GAPPED + f"""
SELECT cell, ts, round(CASE WHEN ia = i THEN qa WHEN ia IS NULL THEN {_lead} WHEN ib IS NULL THEN {_tail} ELSE qa+(qb-qa)*(i-ia)/(ib-ia)::DOUBLE END,6) AS q FROM f""", "obs")
    def interpolate_time_series(t: Tables, direction=_dir):
        return rounded(sequences.interpolate_time_series(_gapped(t), "ts", ["q"], ["cell"], direction, block=4096), "q")


@query("last_n_sequence", """
, r AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY ts DESC) AS rn FROM obs),
s AS (SELECT cell, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts, string_agg(quantity::INT::VARCHAR, ',' ORDER BY ts) AS qs FROM r WHERE rn <= 30 GROUP BY 1)
SELECT cell, first_ts, last_ts, qs FROM s WHERE n = 30""", "obs")
def last_n_sequence(t: Tables):
    seq = sequences.last_n_sequence(t.obs, "cell", "ts", FEATURES, 30)
    return seq.select("cell", F.get("timestamps", F.lit(0)).alias("first_ts"), F.get("timestamps", F.lit(29)).alias("last_ts"),
                      F.array_join(F.transform("observations", lambda o: o[0].cast("int").cast("string")), ",").alias("qs"))


@query("pad_or_truncate", """
, r AS (SELECT *, row_number() OVER (PARTITION BY user_id, acq_date ORDER BY event_id DESC) AS rn FROM hot),
s AS (SELECT user_id, acq_date, least(count(*),3) AS n, string_agg(k::VARCHAR, ',' ORDER BY event_id) FILTER (rn <= 3) AS ks FROM r GROUP BY 1,2)
SELECT user_id, acq_date, CASE n WHEN 1 THEN '0,0,' WHEN 2 THEN '0,' ELSE '' END || ks AS ks FROM s""", "hot")
def pad_or_truncate(t: Tables):
    """Sequences are the (few) detections of one user and day; the newest three are kept before nesting."""
    from pyspark.sql.window import Window

    newest = Window.partitionBy("user_id", "acq_date").orderBy(F.desc("event_id"))
    last = t.hot.select("user_id", "acq_date", "event_id", "k", F.row_number().over(newest).alias("rn")).where("rn <= 3")
    seq = last.groupBy("user_id", "acq_date").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("event_id", "k"))), lambda s: F.array(s["k"].cast("double"))).alias("s"))
    padded = sequences.pad_or_truncate(F.col("s"), 3, 1)
    return seq.select("user_id", "acq_date", F.array_join(F.transform(padded, lambda o: o[0].cast("int").cast("string")), ",").alias("ks"))


@query("sliding_windows", """
, r AS (SELECT cell, ts, quantity, row_number() OVER (PARTITION BY cell ORDER BY ts) AS i, count(*) OVER (PARTITION BY cell) AS n FROM obs),
w AS (SELECT cell, ts, i, n, sum(quantity) OVER (PARTITION BY cell ORDER BY ts ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS sx,
      quantity + lead(quantity) OVER (PARTITION BY cell ORDER BY ts) AS sy FROM r)
SELECT cell, ts, i - 61 AS sample, sx AS sum_x, sy AS sum_y FROM w WHERE i > 60 AND i <= n - 1""", "obs")
def sliding_windows(t: Tables):
    w = sequences.sliding_windows(t.obs, ["cell"], "ts", ["quantity", "discount"], 60, 2)

    def total(c: str):
        return F.aggregate(F.transform(c, lambda o: o[0]), F.lit(0.0), lambda a, v: a + v)

    return w.select("cell", "ts", F.col("sample").cast("bigint").alias("sample"), total("x").alias("sum_x"), total("y").alias("sum_y"))


@query("sample_index", """
, n AS (SELECT count(DISTINCT ts) AS n FROM obs)
SELECT s AS sample, CASE WHEN o < 30 THEN 'x' ELSE 'y' END AS role, CASE WHEN o < 30 THEN o ELSE o - 30 END::INT AS "offset", s + o AS t_idx
FROM n, range(0, n.n - 30) a(s), range(0, 31) b(o)""", "obs")
def sample_index(t: Tables):
    steps = t.obs.agg(F.countDistinct("ts").alias("n"))
    return sequences.sample_index(steps, "n", 30, 1)


@query("lookback_samples", """
, r AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY ts) - 1 AS idx FROM obs)
SELECT cell, ts, idx, is_burning FROM r WHERE idx >= 60""", "obs")
def lookback_samples(t: Tables):
    return sequences.lookback_index(t.obs, "cell", "ts", "is_burning", 60).withColumn("idx", F.col("idx").cast("bigint"))


@query("materialize_samples", """
, r AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY ts) - 1 AS idx,
  sum(quantity) OVER (PARTITION BY cell ORDER BY ts ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS sx, lag(price, 60) OVER (PARTITION BY cell ORDER BY ts) AS oldest FROM obs)
SELECT cell, idx AS anchor, is_burning, sx AS sum_x, oldest AS oldest_price FROM r WHERE idx >= 60""", "obs")
def materialize_samples(t: Tables):
    """The sequence of every anchor that has a whole window before it."""
    chosen = sequences.lookback_index(t.obs, "cell", "ts", "is_burning", 60)
    s = sequences.materialize_samples(chosen, t.obs, "cell", "ts", FEATURES, "is_burning", 60)
    total = F.aggregate(F.transform("x", lambda o: o[0]), F.lit(0.0), lambda a, v: a + v)
    return s.select("cell", F.col("anchor").cast("bigint").alias("anchor"), "is_burning", total.alias("sum_x"),
                    F.get(F.get("x", F.lit(0)), F.lit(1)).alias("oldest_price"))


@query("append_forecast_steps", """
, r AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY ts DESC) AS rn FROM obs)
SELECT cell, string_agg(quantity::INT::VARCHAR, ',' ORDER BY ts) FILTER (rn <= 3) || ',' || (max(discount) FILTER (rn = 1))::VARCHAR AS qs
FROM r GROUP BY 1 HAVING count(*) >= 3""", "obs")
def append_forecast_steps(t: Tables):
    seq = sequences.last_n_sequence(t.obs, "cell", "ts", ["quantity", "discount"], 3)
    last = F.get(F.get("observations", F.lit(2)), F.lit(1))
    hist = F.transform("observations", lambda o: F.array(o[0].cast("int").cast("string")))
    fc = F.array(F.array(last.cast("string")), F.array(F.lit("dropped")))
    joined = sequences.append_forecast_steps(hist, fc)
    return seq.select("cell", F.array_join(F.transform(joined, lambda o: o[0]), ",").alias("qs"))


_AXIS = """
, ax AS (SELECT DISTINCT acq_date AS d, h FROM hot, (VALUES (0),(12)) v(h) WHERE day(acq_date) <= 20),
ti AS (SELECT d::TIMESTAMP + to_hours(h) AS dt, row_number() OVER (ORDER BY d, h) - 1 AS t_idx FROM ax),
de AS (SELECT acq_date::TIMESTAMP + to_hours(CASE WHEN daynight = 'D' THEN 0 ELSE 12 END) AS dt, cell_x, cell_y FROM hot)"""


def _axis(t: Tables):
    from emberfield.operators.ordering import number_rows

    days = t.hot.select("acq_date").distinct().where(F.dayofmonth("acq_date") <= 20)
    both = days.select("acq_date", F.explode(F.array(F.lit(0), F.lit(1))).alias("half")).select(
        time.half_day(F.col("acq_date"), F.col("half")).alias("datetime"))
    return number_rows(both, ["datetime"], "t_idx", 0)


def _placed(t: Tables):
    det = t.hot.select(time.half_day(F.col("acq_date"), fire.daynight_code(F.col("daynight"))).alias("datetime"), "cell_x", "cell_y")
    return sequences.label_grid(det, _axis(t), 8, 9)


@query("label_grid", _AXIS + """SELECT DISTINCT t_idx, cell_y AS "row", cell_x AS "col" FROM de JOIN ti USING (dt) WHERE cell_y < 8 AND cell_x < 9""", "hot")
def label_grid(t: Tables):
    return _placed(t)[0]


@query("label_grid_counts", _AXIS + """
SELECT count(*) FILTER (t_idx IS NOT NULL AND cell_y < 8 AND cell_x < 9) AS placed, count(*) FILTER (t_idx IS NULL) AS out_of_window,
 count(*) FILTER (t_idx IS NOT NULL AND NOT (cell_y < 8 AND cell_x < 9)) AS out_of_bounds FROM de LEFT JOIN ti USING (dt)""", "hot")
def label_grid_counts(t: Tables):
    return _placed(t)[1]


@query("tensor_long", """
, r AS (SELECT lat, row_number() OVER (ORDER BY lat) - 1 AS "row" FROM (SELECT DISTINCT lat FROM hot)),
c AS (SELECT lon, row_number() OVER (ORDER BY lon) - 1 AS "col" FROM (SELECT DISTINCT lon FROM hot)),
ti AS (SELECT acq_date, row_number() OVER (ORDER BY acq_date) - 1 AS t_idx FROM (SELECT DISTINCT acq_date FROM hot))
SELECT t_idx, "row", "col", arg_max(frp, event_id) AS frp, arg_max(brightness, event_id) AS brightness
FROM hot JOIN r USING (lat) JOIN c USING (lon) JOIN ti USING (acq_date) GROUP BY 1,2,3""", "hot")
def tensor_long(t: Tables):
    times = sequences.time_axis(t.hot.withColumn("day", F.col("acq_date").cast(time.NTZ)), "day")
    src = t.hot.withColumn("day", F.col("acq_date").cast(time.NTZ))
    return sequences.tensor_long(src, times, "day", "lat", "lon", ["frp", "brightness"], ["event_id"])


@query("valid_cell_mask", "SELECT DISTINCT cell_x, cell_y FROM hot WHERE bright_t31 > 298", "hot")
def valid_cell_mask(t: Tables):
    src = t.hot.select("cell_x", "cell_y", F.when(F.col("bright_t31") > 298, F.col("bright_t31")).alias("f1"), F.lit(None).cast("double").alias("f2"))
    return sequences.valid_cell_mask(src, ["cell_x", "cell_y"], ["f1", "f2"])


@query("days_since_rain", """
, d AS (SELECT cell_x, acq_date, max(k) AS rain FROM hot GROUP BY 1,2),
w AS (SELECT *, max(CASE WHEN rain >= 98 THEN acq_date END) OVER (PARTITION BY cell_x ORDER BY acq_date) AS wet, min(acq_date) OVER (PARTITION BY cell_x ORDER BY acq_date) AS st FROM d)
SELECT cell_x, acq_date, (CASE WHEN wet IS NOT NULL THEN acq_date - wet ELSE acq_date - st + 1 END)::INT AS days_since_rain FROM w""", "hot")
def days_since_rain(t: Tables):
    daily = t.hot.groupBy("cell_x", "acq_date").agg(F.max("k").alias("rain"))
    return sequences.days_since_rain(daily, "cell_x", "acq_date", "rain", 98).select("cell_x", "acq_date", "days_since_rain")


@query("recent_grid_request", """
, d AS (SELECT cell_x, cell_y, acq_date, max(frp) AS frp, max(bright_t31) AS b FROM hot GROUP BY 1,2,3),
r AS (SELECT *, row_number() OVER (PARTITION BY cell_x, cell_y ORDER BY acq_date DESC) AS rn FROM d)
SELECT 'cell_' || cell_y::VARCHAR || '_' || cell_x::VARCHAR AS id, round(sum(coalesce(b,0)),6) AS total_b, min(acq_date) AS first_day, round(cell_x-0.025::DOUBLE,6) AS west FROM r WHERE rn <= 20
GROUP BY cell_x, cell_y HAVING count(*) = 20""", "hot")
def recent_grid_request(t: Tables):
    d = t.hot.groupBy("cell_x", "cell_y", "acq_date").agg(F.max("frp").alias("frp"), F.max("bright_t31").alias("b"))
    src = d.withColumns({"lat": F.col("cell_y").cast("double"), "lon": F.col("cell_x").cast("double")})
    req = sequences.recent_grid_request(src, "cell_y", "cell_x", "lat", "lon", "acq_date", ["frp", "b"], 20)
    total = F.aggregate(F.transform("observations", lambda o: o[1]), F.lit(0.0), lambda a, v: a + v)
    west = F.get(F.get("rings", F.lit(0)), F.lit(0))["x"]
    return req.select("id", r6(total).alias("total_b"), F.get("timestamps", F.lit(0)).alias("first_day"), r6(west).alias("west"))


# -- splits and weights -----------------------------------------------------

@query("time_split_dates", """
SELECT CASE WHEN ts < TIMESTAMP '1999-01-01' THEN 'train' WHEN ts <= TIMESTAMP '1999-06-30' THEN 'val' WHEN ts >= TIMESTAMP '1999-07-01' THEN 'test' END AS split,
 count(*) AS n, sum(is_burning)::BIGINT AS fires FROM obs GROUP BY 1""", "obs")
def time_split_dates(t: Tables):
    s = splits.time_split_dates(F.col("ts"), ("1999-01-01", "1999-06-30", "1999-07-01"))
    return t.obs.groupBy(s.alias("split")).agg(F.count(F.lit(1)).alias("n"), F.sum("is_burning").cast("bigint").alias("fires"))


@query("time_split_ratio", """
, a AS (SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS t_idx, count(*) OVER () AS n FROM (SELECT DISTINCT ts FROM obs))
SELECT cell, ts, t_idx, CASE WHEN t_idx < floor(floor(n*0.9::DOUBLE)*0.85::DOUBLE) THEN 'train' WHEN t_idx < floor(n*0.9::DOUBLE) THEN 'val' ELSE 'test' END AS split
FROM obs JOIN a USING (ts)""", "obs")
def time_split_ratio(t: Tables):
    return splits.time_split_ratio(t.obs.select("cell", "ts"), "ts")


@query("sequence_split_ratio", """
, a AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS i, count(*) OVER () AS n FROM hot)
SELECT CASE WHEN i < floor(floor(n*0.9::DOUBLE)*0.85::DOUBLE) THEN 'train' WHEN i < floor(n*0.9::DOUBLE) THEN 'val' ELSE 'test' END AS split, count(*) AS n, min(event_id) AS first_id FROM a GROUP BY 1""", "hot")
def sequence_split_ratio(t: Tables):
    s = splits.sequence_split_ratio(t.hot.select("event_id"), ["event_id"])
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"))


@query("negative_subsample", """
, p AS (SELECT event_id, CASE WHEN k = 99 THEN 1 ELSE 0 END AS label, event_id*7919 % 1000003 AS h FROM hot),
r AS (SELECT *, row_number() OVER (ORDER BY h, event_id) AS rn FROM p WHERE label = 0)
SELECT event_id, label FROM p WHERE label = 1 UNION ALL SELECT event_id, label FROM r WHERE rn <= 20 * (SELECT sum(label) FROM p)""", "hot")
def negative_subsample(t: Tables):
    src = t.hot.select("event_id", F.when(F.col("k") == 99, 1).otherwise(0).alias("label"))
    return splits.negative_subsample(src, "label", ["event_id"], order=[F.col("event_id") * 7919 % 1000003]).select("event_id", "label")


@query("stratified_split", """
SELECT satellite, split, CASE WHEN split = 'val' THEN floor(n*0.1::DOUBLE) ELSE n - floor(n*0.1::DOUBLE) END::BIGINT AS n
FROM (SELECT satellite, count(*) AS n FROM hot GROUP BY 1), (VALUES ('val'),('train')) v(split)""", "hot")
def stratified_split(t: Tables):
    return splits.stratified_split(t.hot.select("event_id", "satellite"), "satellite", ["event_id"]).groupBy("satellite", "split").agg(
        F.countDistinct("event_id").alias("n"))


@query("stratified_split_ordered", """
, r AS (SELECT event_id, satellite, row_number() OVER (PARTITION BY satellite ORDER BY user_id, event_id) AS i, count(*) OVER (PARTITION BY satellite) AS n FROM hot)
SELECT event_id, satellite, CASE WHEN i <= floor(n*0.1::DOUBLE) THEN 'val' ELSE 'train' END AS split FROM r""", "hot")
def stratified_split_ordered(t: Tables):
    """The same split with a given order in place of the hash, so every row can be checked."""
    src = t.hot.select("event_id", "satellite", "user_id")
    return splits.stratified_split(src, "satellite", ["event_id"], order=[F.col("user_id")]).drop("user_id")


@query("class_weights", """
, s AS (SELECT count(*) FILTER (is_burning = 1) AS p, count(*) AS n FROM obs WHERE ts < TIMESTAMP '1999-01-01')
SELECT round((n-p)/p,6) AS pos_weight, p AS positives, n-p AS negatives, round(p/n,6) AS positive_rate, round(((n-p)/p)/((n-p)/p+1),6) AS alpha FROM s""", "obs")
def class_weights(t: Tables):
    train = time.NTZ
    return rounded(splits.class_weights(t.obs.where(F.col("ts") < F.lit("1999-01-01").cast(train)), "is_burning"),
                   "pos_weight", "positive_rate", "alpha")


# -- scaling ----------------------------------------------------------------

@query("scale_features_standard", """
SELECT event_id, round((frp-(SELECT avg(frp) FROM hot))/(SELECT stddev_pop(frp) FROM hot),6) AS frp_standard, 0.0::DOUBLE AS flat_standard FROM hot""", "hot")
def scale_features_standard(t: Tables):
    df, _ = scaling.scale_features(t.hot.select("event_id", "frp", F.lit(7.0).alias("flat")), ["frp", "flat"])
    return rounded(df, "frp_standard").drop("frp", "flat")


@query("scale_features_minmax", """
SELECT event_id, round((frp-(SELECT min(frp) FROM hot))/((SELECT max(frp) FROM hot)-(SELECT min(frp) FROM hot)),6) AS frp_minmax FROM hot""", "hot")
def scale_features_minmax(t: Tables):
    return rounded(scaling.scale_features(t.hot.select("event_id", "frp"), ["frp"], "minmax")[0], "frp_minmax").drop("frp")


@query("scale_features_params", "SELECT round(avg(frp),6) AS frp_mean, round(stddev_pop(frp),6) AS frp_std, round(avg(bright_t31),6) AS bright_t31_mean, round(stddev_pop(bright_t31),6) AS bright_t31_std FROM hot", "hot")
def scale_features_params(t: Tables):
    return rounded(scaling.scale_features(t.hot, ["frp", "bright_t31"])[1], "frp_mean", "frp_std", "bright_t31_mean", "bright_t31_std")


@query("fit_apply_scaler", """
, s AS (SELECT avg(bright_t31) AS m, stddev_pop(bright_t31) AS d FROM hot WHERE ts < TIMESTAMP '2024-01-20')
SELECT event_id, round(coalesce((bright_t31-m)/d,0),6) AS bright_t31 FROM hot, s""", "hot")
def fit_apply_scaler(t: Tables):
    params = scaling.fit_scaler(t.hot.where(F.col("ts") < F.lit("2024-01-20").cast(time.NTZ)), ["bright_t31"])
    return rounded(scaling.apply_scaler(t.hot.select("event_id", "bright_t31"), params, ["bright_t31"]), "bright_t31")


@query("inverse_scale", "SELECT event_id, round(frp,6) AS frp FROM hot", "hot")
def inverse_scale(t: Tables):
    params = scaling.fit_scaler(t.hot, ["frp"])
    return rounded(scaling.inverse_scale(scaling.apply_scaler(t.hot.select("event_id", "frp"), params, ["frp"]), params, ["frp"]), "frp")


# -- risk bands and forecasts -----------------------------------------------

_LEVEL = "CASE WHEN p < 0.2 THEN 0 WHEN p < 0.4 THEN 1 WHEN p < 0.6 THEN 2 WHEN p < 0.8 THEN 3 ELSE 4 END"


@query("risk_level", f"""
, l AS (SELECT *, {_LEVEL} AS lv FROM pred)
SELECT event_id, lv AS level, CASE lv WHEN 0 THEN 'LOW' WHEN 1 THEN 'MEDIUM_LOW' WHEN 2 THEN 'MEDIUM' WHEN 3 THEN 'MEDIUM_HIGH' ELSE 'HIGH' END AS label, 5-lv AS factor FROM l""", "pred")
def risk_level(t: Tables):
    lv = fire.risk_level(F.col("p"))
    return t.pred.select("event_id", lv.alias("level"), fire.risk_label(lv).alias("label"), fire.risk_factor(lv).alias("factor"))


@query("risk_vectors", f"""
, two AS (SELECT event_id, p AS p1, (99-k)/99.0::DOUBLE AS p2 FROM pred)
SELECT event_id, {_LEVEL.replace('p <', 'p1 <')}::VARCHAR || ',' || {_LEVEL.replace('p <', 'p2 <')}::VARCHAR AS levels, round((p1+p2)/2,6) AS risk_score,
 (p1 > 0.5)::VARCHAR || ',' || (p2 > 0.5)::VARCHAR AS burning FROM two""", "pred")
def risk_vectors(t: Tables):
    src = t.pred.select("event_id", F.array("p", (99 - F.col("k")) / F.lit(99.0)).alias("fire_probability"))
    out = scoring.risk_table(src)
    return out.select("event_id", F.array_join(F.col("risk_levels").cast("array<string>"), ",").alias("levels"), r6("risk_score").alias("risk_score"),
                      F.array_join(F.col("is_burning_predicted").cast("array<string>"), ",").alias("burning"))


@query("first_horizon_factor", f"SELECT event_id, CASE WHEN k % 11 <> 0 THEN 5 - {_LEVEL} END AS factor FROM pred", "pred")
def first_horizon_factor(t: Tables):
    factors = F.when(F.col("k") % 11 == 0, F.array(F.lit(9))).otherwise(F.array(fire.risk_factor(fire.risk_level(F.col("p"))), F.lit(1)))
    return t.pred.select("event_id", fire.first_horizon_factor(factors).alias("factor"))


@query("score_table", """
, r AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY ts DESC) AS rn FROM obs)
SELECT cell, round(sum(quantity)/60/100,6) AS p1, round(sum(discount)/60,6) AS p2 FROM r WHERE rn <= 60 GROUP BY 1 HAVING count(*) = 60""", "obs")
def score_table(t: Tables):
    """A caller's scorer on batches of sequences: here the means of two features."""
    def scorer(block):
        return block.mean(axis=1) / [100, 1]

    seq = sequences.last_n_sequence(t.obs, "cell", "ts", ["quantity", "discount"], 60).select("cell", "observations")
    out = scoring.score_table(seq, scorer, "observations")
    return out.select("cell", r6(F.get("fire_probability", F.lit(0))).alias("p1"), r6(F.get("fire_probability", F.lit(1))).alias("p2"))


@query("risk_map", """
, m AS (SELECT location_id, grid_latitude AS la, grid_longitude AS lo, (location_id*37 % 100)/99.0::DOUBLE AS p FROM registry)
SELECT location_id, round(lo-0.025,6) AS west, round(la-0.025,6) AS south, 5 - """ + _LEVEL + """ AS risk_factor FROM m""", "registry")
def risk_map(t: Tables):
    src = t.registry.select("location_id", "grid_latitude", "grid_longitude", F.array((F.col("location_id") * 37 % 100) / F.lit(99.0)).alias("fire_probability"))
    out = scoring.risk_table(src)
    ring = F.get(grid.cell_polygon(F.col("grid_latitude"), F.col("grid_longitude")), F.lit(0))
    sw = F.get(ring, F.lit(0))
    return out.select("location_id", r6(sw["x"]).alias("west"), r6(sw["y"]).alias("south"), fire.first_horizon_factor(F.col("risk_factor")).alias("risk_factor"))


# -- metrics ----------------------------------------------------------------

@query("confusion_counts", """
SELECT satellite, count(*) FILTER (p >= 0.5 AND k % 3 = 0) AS tp, count(*) FILTER (p >= 0.5 AND k % 3 <> 0) AS fp,
 count(*) FILTER (p < 0.5 AND k % 3 = 0) AS fn, count(*) FILTER (p < 0.5 AND k % 3 <> 0) AS tn FROM pred GROUP BY 1""", "pred")
def confusion_counts(t: Tables):
    src = t.pred.withColumn("y", F.when(F.col("k") % 3 == 0, 1).otherwise(0))
    return metrics.confusion_counts(src, "y", "p", 0.5, ["satellite"])


@query("climatology_baseline", """
, b AS (SELECT avg(y) AS r FROM pred)
SELECT round(r,6) AS base_rate, round(r,6) AS pr_auc_no_skill, round(r,6) AS always_positive_precision, 1.0::DOUBLE AS always_positive_recall, round(5*r/(4*r+1+1e-12),6) AS always_positive_f2 FROM b""", "pred")
def climatology_baseline(t: Tables):
    return rounded(metrics.climatology_baseline(t.pred, "y"), "base_rate", "pr_auc_no_skill", "always_positive_precision", "always_positive_f2")


_CURVE = """
, s AS (SELECT p, count(*) AS n, sum(y) AS pos FROM pred GROUP BY 1),
c AS (SELECT *, sum(n) OVER (ORDER BY p DESC) AS cn, sum(pos) OVER (ORDER BY p DESC) AS cp, sum(n) OVER () AS tn, sum(pos) OVER () AS tp FROM s),
a AS (SELECT sum(pos/tp*(cp/cn)) AS ap, sum((n-pos)*(cp-pos/2.0::DOUBLE)/tp/(tn-tp)) AS auc FROM c)"""


@query("compute_metrics", _CURVE + """
, k AS (SELECT count(*) AS n, sum(y)::BIGINT AS np, count(*) FILTER (p>=0.5 AND y=1) AS tp, count(*) FILTER (p>=0.5 AND y=0) AS fp, count(*) FILTER (p<0.5 AND y=1) AS fn,
 count(*) FILTER (p<0.5 AND y=0) AS tn, avg((p-y)*(p-y)) AS brier FROM pred),
m AS (SELECT *, tp/(tp+fp) AS pr, tp/(tp+fn) AS rc FROM k)
SELECT n AS n_cells, np AS n_positive, tp, fp, fn, tn, round(brier,6) AS brier, round(pr,6) AS precision, round(rc,6) AS recall, round(5*pr*rc/(4*pr+rc),6) AS f2,
 round(2*pr*rc/(pr+rc),6) AS f1, round(tp/(tp+fp+fn),6) AS iou, round(ap,6) AS pr_auc, round(auc,6) AS roc_auc, round(ap/(np/n),6) AS skill, false AS degenerate FROM m, a""", "pred")
def compute_metrics(t: Tables):
    cols = ["brier", "precision", "recall", "f2", "f1", "iou", "pr_auc", "roc_auc", "skill"]
    return rounded(metrics.compute_metrics(t.pred, "y", "p", 0.5), *cols).select(
        "n_cells", "n_positive", "tp", "fp", "fn", "tn", *cols, "degenerate")


@query("find_best_threshold", _CURVE + """
, f AS (SELECT p, 5*(cp/cn)*(cp/tp)/(4*(cp/cn)+(cp/tp)+1e-12) AS f2 FROM c)
SELECT round(arg_max(p, (f2, -p)),6) AS threshold, round(max(f2),6) AS f2 FROM f""", "pred")
def find_best_threshold(t: Tables):
    return rounded(metrics.find_best_threshold(t.pred, "y", "p"), "threshold", "f2")


@query("flatten_valid", "SELECT event_id, cell_x, cell_y, y, p FROM pred WHERE (cell_x, cell_y) IN (SELECT (cell_x, cell_y) FROM hot WHERE bright_t31 > 298)", "pred hot")
def flatten_valid(t: Tables):
    p = t.pred.select("event_id", "cell_x", "cell_y", "p")
    y = t.pred.select("event_id", "cell_x", "cell_y", "y")
    return metrics.flatten_valid(p, y, valid_cell_mask(t), ["event_id", "cell_x", "cell_y"], ["cell_x", "cell_y"])


@query("regression_metrics", """
, e AS (SELECT 'quantity' AS feature, l_quantity AS a, l_quantity + l_discount*10 - 0.5 AS p FROM lineitem UNION ALL SELECT 'tax', l_tax, l_discount FROM lineitem)
SELECT coalesce(feature,'overall') AS feature, round(avg(abs(a-p)),6) AS mae, round(sqrt(avg((a-p)*(a-p))),6) AS rmse,
 CASE WHEN feature = 'quantity' THEN round(avg(abs((a-p)/(a+1e-8)))*100,4) END AS mape FROM e GROUP BY ROLLUP(feature)""")
def regression_metrics(t: Tables):
    src = t.table("lineitem").withColumn("pred", F.col("l_quantity") + F.col("l_discount") * 10 - 0.5)
    out = metrics.regression_metrics(src, {"quantity": ("l_quantity", "pred"), "tax": ("l_tax", "l_discount")})
    # tax can be zero, where a percentage error means nothing
    return rounded(out, "mae", "rmse").withColumn("mape", F.when(F.col("feature") == "quantity", F.round("mape", 4)))


@query("classification_report", """
, r AS (SELECT toxic AS y, (n_chars % 2)::INT AS q FROM labels JOIN documents USING (doc_id)),
k AS (SELECT count(*) AS n, count(*) FILTER (y=1 AND q=1) AS tp, count(*) FILTER (y=0 AND q=1) AS fp, count(*) FILTER (y=1 AND q=0) AS fn, count(*) FILTER (y=0 AND q=0) AS tn FROM r)
SELECT n, tp, fp, fn, tn, round((tp+tn)/n,6) AS accuracy, round(tp/(tp+fp),6) AS precision, round(tp/(tp+fn),6) AS recall, round(2*tp/(2*tp+fp+fn),6) AS f1,
 round((2*tp/(2*tp+fp+fn)+2*tn/(2*tn+fn+fp))/2,6) AS macro_f1 FROM k""")
def classification_report(t: Tables):
    src = t.table("labels").join(t.table("documents").select("doc_id", "n_chars"), "doc_id").select(
        F.col("toxic").alias("y"), (F.col("n_chars") % 2).alias("q"))
    cols = ["accuracy", "precision", "recall", "f1", "macro_f1"]
    return rounded(metrics.classification_report(src, "y", "q"), *cols).select("n", "tp", "fp", "fn", "tn", *cols)


@query("class_counts", "SELECT y AS actual, k % 2 AS predicted, count(*) AS n FROM pred GROUP BY 1,2", "pred")
def class_counts(t: Tables):
    return metrics.class_counts(t.pred.withColumn("q", F.col("k") % 2), "y", "q")


@query("evaluation_summary", """
, s AS (SELECT daynight, p, count(*) AS n, sum(y) AS pos FROM pred GROUP BY 1,2),
c AS (SELECT *, sum(pos) OVER (PARTITION BY daynight ORDER BY p DESC) AS cp, sum(n) OVER (PARTITION BY daynight) AS tn, sum(pos) OVER (PARTITION BY daynight) AS tp FROM s),
a AS (SELECT daynight, sum((n-pos)*(cp-pos/2.0::DOUBLE)/tp/(tn-tp)) AS auc FROM c GROUP BY 1),
k AS (SELECT daynight, count(*) FILTER (p>=0.5 AND y=1) AS tp, count(*) FILTER (p>=0.5 AND y=0) AS fp, count(*) FILTER (p<0.5 AND y=1) AS fn, count(*) FILTER (p<0.5 AND y=0) AS tn FROM pred GROUP BY 1)
SELECT daynight, tp, fp, fn, tn, round(auc,6) AS roc_auc, round(tp/(tp+fp),6) AS precision, round(tp/(tp+fn),6) AS recall, round(2*tp/(2*tp+fp+fn),6) AS f1,
 round(fp/(fp+tn),6) AS false_alarm_rate FROM k JOIN a USING (daynight)""", "pred")
def evaluation_summary(t: Tables):
    return rounded(metrics.evaluation_summary(t.pred, "daynight", "y", "p"), "roc_auc", "precision", "recall", "f1", "false_alarm_rate")


@query("auc_gap", """
, s AS (SELECT daynight, p, count(*) AS n, sum(y) AS pos FROM pred GROUP BY 1,2),
c AS (SELECT *, sum(pos) OVER (PARTITION BY daynight ORDER BY p DESC) AS cp, sum(n) OVER (PARTITION BY daynight) AS tn, sum(pos) OVER (PARTITION BY daynight) AS tp FROM s),
a AS (SELECT daynight, sum((n-pos)*(cp-pos/2.0::DOUBLE)/tp/(tn-tp)) AS auc FROM c GROUP BY 1),
g AS (SELECT abs(max(auc)-min(auc)) AS g FROM a) SELECT round(g,6) AS auc_gap, g < 0.02 AS stable FROM g""", "pred")
def auc_gap(t: Tables):
    summary = metrics.evaluation_summary(t.pred, "daynight", "y", "p")
    return rounded(metrics.auc_gap(summary, "daynight", "D", "N"), "auc_gap")


@query("loss_terms", """
, z AS (SELECT y::DOUBLE AS y, p*4-2 AS z, 1/(1+exp(-(p*4-2))) AS q FROM pred),
t AS (SELECT *, greatest(z,0)-z*y+ln(1+exp(-abs(z))) AS bce, q*y+(1-q)*(1-y) AS pt FROM z)
SELECT round(avg((0.85*y+0.15*(1-y))*pow(1-pt,2)*bce),6) AS focal, round(1-(sum(q*y)+1e-6)/(sum(q*y)+0.3*sum(q*(1-y))+0.7*sum((1-q)*y)+1e-6),6) AS tversky,
 round(avg((z-y)*(z-y)),6) AS mse FROM t""", "pred")
def loss_terms(t: Tables):
    src = t.pred.withColumn("z", F.col("p") * 4 - 2)
    return rounded(metrics.loss_terms(src, "y", "z"), "focal", "tversky", "mse")


@query("baseline_scorer", """
, d AS (SELECT *, CASE WHEN ts < TIMESTAMP '1998-01-01' THEN 'train' ELSE 'test' END AS split, quantity % 10 <> 0 AS known FROM obs)
SELECT cell, ts, is_burning, split, known AS scored, CASE WHEN known THEN true END AS is_probability, true AS split_ranks_better_than_chance FROM d""", "obs")
def baseline_scorer(t: Tables):
    """Class-weighted logistic regression, trained on the earlier years and scored on all rows.

    A row without a feature keeps its place with a NULL score. The test years' ranking must not be worse than chance.
    """
    price = F.when(F.col("quantity") % 10 != 0, F.col("price") / 1000.0)
    split = F.when(F.col("ts") < F.lit("1998-01-01").cast(time.NTZ), "train").otherwise("test")
    src = t.obs.withColumns({"price": price, "split": split})
    train = src.where("split = 'train'")
    w = splits.class_weights(train, "is_burning").first()["pos_weight"]
    scored = scoring.apply_baseline(scoring.train_baseline(train, FEATURES, "is_burning", w), src)
    ranks = scored.where("p is not null").groupBy("split").agg(
        (F.avg(F.when(F.col("is_burning") == 1, F.col("p"))) >= F.avg(F.when(F.col("is_burning") == 0, F.col("p"))) - 0.01).alias("split_ranks_better_than_chance"))
    return scored.join(F.broadcast(ranks), "split").select(
        "cell", "ts", "is_burning", "split", F.col("p").isNotNull().alias("scored"), F.col("p").between(0, 1).alias("is_probability"), "split_ranks_better_than_chance")
