"""What a task holds follows the number of partitions that the input needs, and small sides are sent to large ones."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberfield import session
from emberfield.operators import copies, fires, nearest, polygons, quality, sequences
from emberfield.plans import catalogue
from emberfield.plans.bindings import diamond


@pytest.fixture
def large(monkeypatch):
    monkeypatch.setattr(session, "data_partitions", lambda df, per_task=0: 41)  # as for an input of many files


@pytest.fixture
def no_automatic_broadcast(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_coverage_is_dealt_by_its_keys(spark, large):
    left = spark.createDataFrame([(1, None), (1, None), (2, 5), (3, 5)], "k long, d long")
    out = quality.coverage_diff(left, left.where("k > 1").union(spark.createDataFrame([(9, 9)], left.schema)), ["k", "d"])
    assert ", 41)" in _plan(out)
    assert tuple(out.first()) == (1, 1, False)


@pytest.mark.parametrize("direction,ends", [("forward", (None, 4.0)), ("backward", (2.0, None)), ("both", (2.0, 4.0))])
def test_interpolation_is_dealt_by_block(spark, large, direction, ends):
    rows = [(g, t, {1: 2.0, 3: 4.0}.get(t)) for g in (None, 1, 2) for t in range(5)]
    out = sequences.interpolate_time_series(spark.createDataFrame(rows, "g long, t long, v double"), "t", ["v"], ["g"], direction, block=2)
    assert "hashpartitioning(_key" in _plan(out) and ", 41)" in _plan(out)
    got = {(r.g, r.t): r.v for r in out.collect()}
    assert got == {(g, t): v for g in (None, 1, 2) for t, v in enumerate([ends[0], 2.0, 3.0, 4.0, ends[1]])}


def test_nearest_deals_its_points(spark, large, tmp_path):
    points = spark.range(60).select((F.col("id") / 7 - 38).alias("a"), (F.col("id") / 5 + 141).alias("o"))
    targets = spark.range(300).select("id", (F.col("id") * 7 % 60 / 7 - 38.01).alias("a"), (F.col("id") % 60 / 5 + 141).alias("o"))
    out = nearest.nearest_join(points, targets, ("a", "o"), ("a", "o"), "id")
    assert ", 41)" in _plan(out) and out.count() == 60


def _lines(spark, path):
    rows = [(s, datetime(1996, 1, 1) + timedelta(days=400 * d + s), float(1 + (s * 7 + d * 3) % 40), float(100 * s + d), 0.01 * d, 0.02, "RNA"[(s + d) % 3])
            for s in range(40) for d in range(4)]
    spark.createDataFrame(rows, "l_suppkey long, l_shipdate timestamp_ntz, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string").write.parquet(f"{path}/lineitem.parquet")


def test_scores_are_not_dealt_by_split(spark, tmp_path, no_automatic_broadcast):
    _lines(spark, tmp_path)
    out = catalogue()["baseline_scorer"].run(spark, str(tmp_path))
    plan = _plan(out)
    assert "BroadcastHashJoin [split" in plan and "SortMergeJoin [split" not in plan
    assert out.count() == 160


def test_alignment_counts_keys_without_texts(spark):
    schema = "g long, i long, ts long"
    left = spark.createDataFrame([(1, 1, 1), (2, 1, 2), (None, 3, 1)], schema)
    right = spark.createDataFrame([(1, 1, 2), (2, 2, 1), (None, 3, None)], schema)
    out = quality.grid_alignment_summary(left, right, "g", "i", "ts")
    assert "to_json" not in _plan(out)
    got = {r["check"]: r.passed for r in out.collect()}
    assert got == {"same_geometries": True, "same_times": False, "same_geometry_times": False, "left_grid_id_unique": False, "right_grid_id_unique": True}
    assert not quality.grid_alignment_summary(left.limit(0), right.limit(0), "g", "i", "ts").collect()


def _shapes(spark):
    at = spark.range(30).select("id", (F.col("id") * 0.03).alias("x"), (F.col("id") * 0.02).alias("y"))
    cells = spark.range(100).select((F.col("id") % 10 * 0.1).alias("w"), (F.floor(F.col("id") / 10) * 0.1).alias("s"))
    return at.select("id", diamond(F.col("x"), F.col("y"), F.lit(0.02)).alias("rings")), cells.select("w", "s", (F.col("w") + 0.1).alias("e"), (F.col("s") + 0.1).alias("n"))


def test_few_boxes_are_sent_to_the_shapes(spark, no_automatic_broadcast):
    shapes, cells = _shapes(spark)
    plan = _plan(polygons.boxes_intersect_polygons(cells, shapes, ("w", "s", "e", "n"), "rings", 0.1))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "RoundRobin" not in plan
    below = plan[plan.index("xxhash64"):]
    assert "array_min" not in below and "array_max" not in below  # bounds are not made again where the shapes are read


def test_overlay_sends_few_cells_and_turns_small_shapes_where_they_are(spark, large, no_automatic_broadcast):
    shapes, cells = _shapes(spark)
    out = polygons.overlay_areas(cells, shapes, ("w", "s", "e", "n"), "rings", 0.1)
    assert "SortMergeJoin [bx" not in _plan(out) and ", 41)" in _plan(out)
    whole = out.groupBy("id").agg(F.sum("overlap_share").alias("a")).where("id between 1 and 29").collect()
    assert len(whole) == 29 and all(abs(r.a - 1) < 1e-9 for r in whole)


def test_fires_are_dealt_by_id(spark, monkeypatch):
    monkeypatch.setattr(fires, "data_partitions", lambda df, per_task=0: 41)
    day = F.lit("2020-01-01").cast("timestamp_ntz")
    some = spark.range(20).select(F.col("id").alias("fire_id"), day.alias("ignition_date"), F.lit(1.0).alias("area_ha"), F.lit("small").alias("size_class"), F.lit("Summer").alias("season"))
    seen = some.select("fire_id", "ignition_date", day.alias("datetime"), F.lit(2.0).alias("frp_peak"), F.lit(3.0).alias("frp_cumulative"))
    out = fires.unify_fires(some, seen)
    assert "hashpartitioning(fire_id" in _plan(out) and ", 41)" in _plan(out) and out.count() == 20


def test_nearest_does_not_shuffle_its_points_per_level(spark, monkeypatch, no_automatic_broadcast):
    monkeypatch.setattr(nearest, "_BROADCAST_ROWS", 20)  # as for a tree too large to be sent
    rows = spark.range(4000).select((F.col("id") % 2).alias("day"), (F.col("id") % 61 * 0.1 - 39).alias("a"), (F.floor(F.col("id") / 61) * 0.13 + 141).alias("o"), "id")
    out = nearest.nearest_join(rows.where("id % 7 = 0"), rows, ("a", "o"), ("a", "o"), "id", by=["day"])
    assert "Join" not in _plan(out)  # all settled by their own leaf and its neighbours
    assert out.where("distance = 0").count() == out.count() == rows.where("id % 7 = 0").count()


@pytest.mark.parametrize("metric", [nearest.EUCLID_DEGREES, nearest.EQUIRECT_KM])
def test_nearest_over_large_trees_is_exact(spark, monkeypatch, metric):
    monkeypatch.setattr(nearest, "_BROADCAST_ROWS", 20)
    rng = np.random.default_rng(5)
    crowd, wide = rng.normal([-37, 145], 0.003, (900, 2)).round(4), rng.uniform([-39, 141], [-34, 150], (400, 2)).round(2)
    t = np.r_[crowd, wide, wide[:50]]  # co-located targets: the lowest id wins
    p = np.r_[rng.uniform([-39.5, 140], [-33, 151], (150, 2)).round(2), rng.normal([-37, 145], 0.02, (100, 2)).round(4), wide[:30]]
    day = lambda n, of: np.arange(n) % of
    targets = [(int(d), float(a), float(o), i) for i, (d, (a, o)) in enumerate(zip(day(len(t), 2), t))] + [(None, -37.0, 145.0, -1), (0, None, 145.0, -2)]
    points = [(int(d), float(a), float(o)) for d, (a, o) in zip(day(len(p), 3), p)] + [(None, -37.0, 145.0)]  # day 2 has no target
    out = nearest.nearest_join(spark.createDataFrame(points, "day long, a double, o double"), spark.createDataFrame(targets, "day long, a double, o double, id long"),
                               ("a", "o"), ("a", "o"), "id", metric, by=["day"]).collect()
    got = {(r.day, r.a, r.o): (r.target_id, r.distance) for r in out}
    assert set(got) == {x for x in points if x[0] in (0, 1)}
    km = 111.32 if metric is nearest.EQUIRECT_KM else 1.0
    for (d, a, o), (i, dist) in got.items():
        mine = [x for x in targets if x[0] == d and x[1] is not None]
        at = np.array([x[1:3] for x in mine])
        far = np.hypot((at[:, 0] - a) * km, (at[:, 1] - o) * km * (np.cos(np.radians(a)) if km > 1 else 1))
        assert abs(dist - far.min()) < 1e-9 and i in {x[3] for x, f in zip(mine, far) if f <= far.min() + 1e-9}
        assert i == min(x[3] for x in mine if x[1:3] == targets[i][1:3])


def _crowd(spark):
    """600 points at 4 places, 300 of them at one; 900 shapes of 3 outlines, 600 of them equal."""
    points = spark.range(600).select("id", F.when(F.col("id") < 300, 1.0).otherwise(F.col("id") % 4 - 0.0).alias("x"), F.lit(0.5).alias("y"))
    points = points.unionByName(spark.createDataFrame([(-1, None, 0.5), (-1, None, 0.5)], points.schema))
    at = spark.range(900).select(F.col("id").alias("fire"), F.when(F.col("id") < 600, 1.0).otherwise(F.col("id") % 3 + 7 * (F.col("id") % 3 - 1)).alias("c"))
    return points, at.select("fire", diamond(F.col("c"), F.lit(0.5), F.lit(0.3)).alias("rings"))


def _pairs(rows):
    return sorted((r.id, -1 if r.fire is None else r.fire) for r in rows)


def _centre(fire):
    return 1.0 if fire < 600 else fire % 3 + 7 * (fire % 3 - 1)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_equal_places_and_shapes_are_settled_once(spark, how):
    points, shapes = _crowd(spark)
    out = polygons.points_in_polygons(points, shapes, "x", "y", "rings", 0.5, how)
    want = [(i, f) for i in range(600) for f in range(900) if _centre(f) == (1.0 if i < 300 else i % 4)]
    lone = [(i, -1) for i in range(300, 600) if i % 4 != 1] + [(-1, -1)] * 2
    assert _pairs(out.collect()) == sorted(want + (lone if how == "left" else []))
    assert out.columns == ["id", "x", "y", "fire"] and "collect_list" in _plan(out)


def test_equal_shapes_meet_boxes_once(spark):
    _, shapes = _crowd(spark)
    boxes = spark.createDataFrame([(1, 0.9, 0.4, 1.1, 0.6), (1, 0.9, 0.4, 1.1, 0.6), (2, 3.0, 0.0, 3.5, 1.0)], "id long, w double, s double, e double, n double")
    out = polygons.boxes_intersect_polygons(boxes, shapes, ("w", "s", "e", "n"), "rings", 0.5)
    assert _pairs(out.collect()) == sorted([(1, f) for f in range(900) if _centre(f) == 1.0] * 2)
    assert "collect_list" in _plan(out)


def test_many_to_many_expands_gathered_rows(spark):
    left = spark.range(700).select((F.col("id") % 2).alias("k"), F.lit(None).cast("int").alias("none"), F.col("id").alias("id"))
    left = left.unionByName(spark.createDataFrame([(None, 1, -1), (0, None, 0)], left.schema))  # a key that is null, a row that comes twice
    right = spark.range(90).select((F.col("id") % 3).alias("k"), F.col("id").alias("fire"))
    out = copies.many_to_many(left, right, ["k"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, left.join(right, "k").select("k", "none", "id", "fire").collect()), key=str)
    assert "collect_list" in _plan(out) and out.count() == 701 * 30
    most = max(len(r.rows) for r in copies.gathered(left, ["k"], ["id"], "rows")[0].collect())
    assert most < 350  # a key of many rows is parted


def test_many_to_many_makes_and_deals_its_right_side_once(spark, monkeypatch, no_automatic_broadcast):
    monkeypatch.setattr(copies, "sized_broadcast", lambda df, rows=0: df)
    made = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda k: made.add(1) or k, "long")
    left = spark.range(40).select((F.col("id") % 4).alias("k"), F.col("id").alias("event"))
    right = spark.range(200).select(seen(F.col("id") % 5).alias("k"), F.col("id").alias("fire"), F.lit(None).cast("string").alias("event_"))
    out = copies.many_to_many(left, right, ["k"])
    plan = _plan(out)
    assert made.value == 0 and plan.count("collect_list") <= 2  # partial and final of the left side alone
    got = sorted((r.event, r.fire) for r in out.collect())
    assert got == [(e, f) for e in range(40) for f in range(200) if e % 4 == f % 5] and out.columns == ["k", "event", "fire", "event_"]
