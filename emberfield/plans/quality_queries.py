"""Quality gates on the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberfield.operators import quality, sequences
from emberfield.plans.bindings import Tables, diamond
from emberfield.plans.registry import query


@query("table_check", """
SELECT count(*) FILTER (bright_t31 IS NULL) AS null_values, false AS no_nulls, true AS location_set, count(*) = count(DISTINCT event_id) AS pk_unique FROM hot""", "hot")
def table_check(t: Tables):
    return quality.table_check(t.hot.select("event_id", F.col("cell_x").alias("location_id"), "bright_t31"))


@query("fire_report", """
SELECT count(*) AS rows, count(*) FILTER (bright_t31 IS NULL) AS null_values, true AS lat_valid, true AS lon_valid,
 count(*) - (SELECT count(*) FROM (SELECT DISTINCT cell_x, cell_y, bright_t31, acq_date FROM hot)) AS duplicate_rows FROM hot""", "hot")
def fire_report(t: Tables):
    src = t.hot.select(F.col("cell_x").alias("latitude"), F.col("cell_y").alias("longitude"), "bright_t31", "acq_date")
    return quality.fire_report(src)


@query("weather_report", """
SELECT count(*) AS rows, count(*) FILTER (bright_t31 IS NULL) AS null_values, count(*) FILTER (k*1.2::DOUBLE-10 NOT BETWEEN 0 AND 100) AS bad_humidity,
 count(*) FILTER (frp - 5 < 0) AS bad_wind, count(*) FILTER (bright_t31 - 235 NOT BETWEEN -50 AND 60) AS bad_temperature,
 count(*) - (SELECT count(*) FROM (SELECT DISTINCT k, frp, bright_t31 FROM hot)) AS duplicate_rows FROM hot""", "hot")
def weather_report(t: Tables):
    src = t.hot.select((F.col("k") * F.lit(1.2) - 10).alias("h"), (F.col("frp") - 5).alias("w"), (F.col("bright_t31") - 235).alias("c"))
    return quality.weather_report(src, "h", "w", "c")


@query("required_fields", "SELECT count(*) AS rows, count(*) FILTER (c_custkey % 9 = 0 OR c_custkey % 14 = 0) AS missing_required FROM customer")
def required_fields(t: Tables):
    k = F.col("c_custkey")
    src = t.table("customer").select(F.when(k % 9 != 0, F.col("c_name")).alias("a"), F.when(k % 14 != 0, F.col("c_name")).otherwise("").alias("b"))
    return quality.required_fields(src, ["a", "b"])


@query("unique_keys", """
SELECT count(*) AS duplicate_keys, coalesce(sum(n),0)::BIGINT AS duplicate_rows FROM (SELECT l_suppkey, l_shipdate, count(*) AS n FROM lineitem GROUP BY 1,2 HAVING count(*) > 1)""")
def unique_keys(t: Tables):
    return quality.unique_keys(t.table("lineitem"), ["l_suppkey", "l_shipdate"])


@query("coverage_diff", """
, a AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderstatus = 'F')
SELECT (SELECT count(*) FROM a WHERE k NOT IN (SELECT k FROM b)) AS left_only, (SELECT count(*) FROM b WHERE k NOT IN (SELECT k FROM a)) AS right_only, false AS equal""")
def coverage_diff(t: Tables):
    a = t.table("lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("k"))
    b = t.table("orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k"))
    return quality.coverage_diff(a, b, ["k"])


@query("coverage_equal", "SELECT 0::BIGINT AS left_only, 0::BIGINT AS right_only, true AS equal FROM (SELECT count(*) FROM obs)", "obs")
def coverage_equal(t: Tables):
    keys = ["cell", "ts"]
    lineitem = t.table("lineitem").select(F.col("l_suppkey").alias("cell"), F.col("l_shipdate").alias("ts"))
    quality.coverage_equal(t.obs.select(*keys), lineitem, keys)
    return quality.coverage_diff(t.obs.select(*keys), lineitem, keys)


@query("shared_metadata_equal", """
SELECT count(*) FILTER (c_custkey % 6 = 0) AS name_differs, 0::BIGINT AS segment_differs FROM customer""")
def shared_metadata_equal(t: Tables):
    k = F.col("c_custkey")
    a = t.table("customer").select("c_custkey", F.when(k % 5 != 0, F.col("c_name")).alias("name"), F.col("c_mktsegment").alias("segment"))
    b = a.withColumn("name", F.when(k % 6 == 0, "other").otherwise(F.col("name")))
    return quality.shared_metadata_equal(a, b, ["c_custkey"], ["name", "segment"])


@query("label_domain", "SELECT quality + toxic*2 AS label, count(*) AS rows FROM labels WHERE quality + toxic*2 NOT IN (0,1) GROUP BY 1")
def label_domain(t: Tables):
    return quality.label_domain(t.table("labels").select((F.col("quality") + F.col("toxic") * 2).alias("label")), "label", [0, 1])


def _requests(t: Tables):
    seq = sequences.last_n_sequence(t.obs, "cell", "ts", ["quantity", "price", "discount", "tax"], 60)
    return seq.select(F.col("cell").cast("string").alias("id"), "observations", "timestamps",
                      (F.col("cell") % 10).alias("grid_row"), F.floor(F.col("cell") / 10).alias("grid_col"))


@query("forecast_request", """
, n AS (SELECT cell FROM obs GROUP BY 1 HAVING count(*) >= 60)
SELECT count(*) AS features, 0::BIGINT AS empty_series, true AS equal_lengths, true AS equal_widths, 4 AS n_features, 0::BIGINT AS bad_timestamps, 0::BIGINT AS half_positions,
 0::BIGINT AS negative_positions, 0::BIGINT AS duplicate_cells, true AS valid FROM n""", "obs")
def forecast_request(t: Tables):
    return quality.forecast_request(_requests(t), 4)


@query("sequence_shape_contract", """
, n AS (SELECT cell FROM obs GROUP BY 1 HAVING count(*) >= 60) SELECT count(*) AS rows, 0::BIGINT AS bad_shape FROM n""", "obs")
def sequence_shape_contract(t: Tables):
    return quality.sequence_shape_contract(_requests(t), "observations", 60, 4)


@query("forecast_response", "SELECT count(*) AS rows, count(*) FILTER (k % 9 = 0) AS uneven_rows FROM pred", "pred")
def forecast_response(t: Tables):
    p = F.col("p")
    src = t.pred.select(F.array(p, p).alias("fire_probability"), F.when(F.col("k") % 9 == 0, F.array(p)).otherwise(F.array(p, p)).alias("risk_levels"),
                        F.lit(None).cast("array<int>").alias("risk_labels"))
    return quality.forecast_response(src, ["fire_probability", "risk_levels", "risk_labels"])


@query("map_contract", """
SELECT count(*) AS rows, 0::BIGINT AS short_rings, 0::BIGINT AS open_rings, 0::BIGINT AS bad_coordinates, count(*) FILTER (fire_id % 8 IN (0,6,7)) AS bad_factor,
 count(*) FILTER (area_ha > 1) AS bad_probability FROM fires""", "fires")
def map_contract(t: Tables):
    src = t.fires.select(diamond(F.col("lon"), F.col("lat"), F.col("half")).alias("rings"), (F.col("fire_id") % 8).alias("risk_factor"), F.col("area_ha").alias("p"))
    return quality.map_contract(src, probability="p")


@query("grid_ids_multi_geometry", "SELECT user_id, count(DISTINCT lat) AS geometries FROM hot GROUP BY 1 HAVING count(DISTINCT lat) > 1", "hot")
def grid_ids_multi_geometry(t: Tables):
    return quality.grid_ids_multi_geometry(t.hot, "user_id", "lat")


@query("grid_alignment_summary", """
, a AS (SELECT cell AS g, cell % 50 AS i, ts FROM obs), b AS (SELECT l_suppkey AS g, l_suppkey AS i, l_shipdate AS ts FROM lineitem WHERE l_quantity < 45)
SELECT 'same_geometries' AS "check", NOT EXISTS ((SELECT g FROM a EXCEPT SELECT g FROM b) UNION ALL (SELECT g FROM b EXCEPT SELECT g FROM a)) AS passed
UNION ALL SELECT 'same_times', NOT EXISTS ((SELECT ts FROM a EXCEPT SELECT ts FROM b) UNION ALL (SELECT ts FROM b EXCEPT SELECT ts FROM a))
UNION ALL SELECT 'same_geometry_times', NOT EXISTS ((SELECT g, ts FROM a EXCEPT SELECT g, ts FROM b) UNION ALL (SELECT g, ts FROM b EXCEPT SELECT g, ts FROM a))
UNION ALL SELECT 'left_grid_id_unique', NOT EXISTS (SELECT 1 FROM a GROUP BY i HAVING count(DISTINCT g) > 1)
UNION ALL SELECT 'right_grid_id_unique', NOT EXISTS (SELECT 1 FROM b GROUP BY i HAVING count(DISTINCT g) > 1)""", "obs")
def grid_alignment_summary(t: Tables):
    a = t.obs.select(F.col("cell").alias("g"), (F.col("cell") % 50).alias("i"), "ts")
    b = t.table("lineitem").where("l_quantity < 45").select(F.col("l_suppkey").alias("g"), F.col("l_suppkey").alias("i"), F.col("l_shipdate").alias("ts"))
    return quality.grid_alignment_summary(a, b, "g", "i", "ts")


@query("temporal_structure", """
SELECT year(ts)::INT AS year, count(DISTINCT ts) AS timestamps, min(ts) AS "first", max(ts) AS "last", count(DISTINCT ts) = 365 AS complete, true AS hours_ok FROM obs GROUP BY 1""", "obs")
def temporal_structure(t: Tables):
    return quality.temporal_structure(t.obs, "ts", 365, [0, 12])


@query("profile", """
SELECT 'event_id' AS "column", 'bigint' AS type, count(*) AS rows, 0::BIGINT AS nulls, count(DISTINCT event_id) AS distinct_values FROM hot
UNION ALL SELECT 'satellite', 'string', count(*), 0, count(DISTINCT satellite) FROM hot
UNION ALL SELECT 'bright_t31', 'double', count(*), count(*) FILTER (bright_t31 IS NULL), count(DISTINCT bright_t31) FROM hot""", "hot")
def profile(t: Tables):
    return quality.profile(t.hot.select("event_id", "satellite", "bright_t31"))


@query("synthetic_post_schema", """
, s AS (SELECT *, CASE WHEN post_id % 20 < 14 THEN 'train' WHEN post_id % 20 < 17 THEN 'validation' ELSE 'test' END AS split FROM posts),
th AS (SELECT author_name, count(*) AS n FROM s WHERE split = 'train' GROUP BY 1)
SELECT count(*) AS rows, 0::BIGINT AS missing_required, count(*) FILTER (platform NOT IN ('TWITTER','FACEBOOK')) AS bad_platform, count(*) FILTER (length(content) NOT BETWEEN 20 AND 300) AS bad_length,
 0::BIGINT AS bad_credibility, count(*) FILTER (post_id % 50 = 0) AS bad_time, count(*) FILTER (post_id % 50 <> 0) AS unusual_year,
 abs(count(*) FILTER (split='train')/count(*) - 0.70) <= 0.05 AS train_share_ok, abs(count(*) FILTER (split='validation')/count(*) - 0.15) <= 0.05 AS validation_share_ok,
 abs(count(*) FILTER (split='test')/count(*) - 0.15) <= 0.05 AS test_share_ok, 0::BIGINT AS duplicate_ids,
 (SELECT count(*) FROM th WHERE n < 0.05*(SELECT sum(n) FROM th)) AS rare_themes FROM s""", "posts")
def synthetic_post_schema(t: Tables):
    i = F.col("post_id")
    src = t.posts.select(
        i.alias("id"), "platform", F.col("content").alias("text"), F.col("score").alias("credibility"),
        F.when(i % 50 == 0, "soon").otherwise(F.col("ts").cast("string")).alias("created"), F.col("author_name").alias("theme"),
        F.when(i % 20 < 14, "train").when(i % 20 < 17, "validation").otherwise("test").alias("split"))
    return quality.synthetic_post_schema(src, ["TWITTER", "FACEBOOK"])


@query("target_schema", "SELECT count(*) AS approved FROM registry WHERE location_id BETWEEN 1 AND 463807", "registry")
def target_schema(t: Tables):
    target = t.table("documents").select(F.col("doc_id").cast("string").alias("id"))
    quality.target_schema(target, t.registry, 1, 463807)
    return t.registry.where(F.col("location_id").between(1, 463807)).agg(F.count(F.lit(1)).alias("approved"))


