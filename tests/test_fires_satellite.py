"""Fire life cycle and neighbour counts against hand-derived answers and brute force."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from emberfield.functions import fire, time
from emberfield.operators import fires, satellite


def test_life_cycle(spark):
    d = dt.datetime(2020, 1, 1)
    base = spark.createDataFrame(
        [(1, d, "large"), (2, d, "small"), (3, d, "mega"), (4, d, None), (5, d, "small")], "fire_id int, ignition_date timestamp_ntz, size_class string")
    days = {1: [0, 2, 4, 9, 10], 5: [-1]}
    seen = [(f, d + dt.timedelta(days=x), d, float(x), 1.0) for f, xs in days.items() for x in xs] + [(3, d + dt.timedelta(days=6), d, 1.0, 1.0)]
    det = spark.createDataFrame(seen, "fire_id int, datetime timestamp_ntz, ignition_date timestamp_ntz, frp_peak double, frp_cumulative double")
    out = {r.fire_id: r for r in fires.unify_fires(base, det).collect()}
    assert out[1].extinguish_date == d + dt.timedelta(days=4) and out[1].duration_days == 4.0 and out[1].peak_frp == 10.0
    assert out[2].detection_status == "imputed_same_day" and out[2].duration_days == 0.25
    assert out[3].detection_status == "coverage_gap"  # first seen six days late
    assert out[4].detection_status == "never_detected" and out[4].extinguish_date is None
    assert out[5].extinguish_date == d + dt.timedelta(hours=6)  # ended before the recorded ignition


def test_gap_must_exceed_four_days(spark):
    d = dt.datetime(2020, 1, 1)
    det = spark.createDataFrame([(1, d), (1, d + dt.timedelta(days=4)), (1, d + dt.timedelta(days=9))], "fire_id int, datetime timestamp_ntz")
    assert fires.estimate_extinguish(det).first().extinguish_date == d + dt.timedelta(days=4)


def test_synthetic_ids(spark):
    df = spark.createDataFrame([(1, "7"), (2, None), (3, None)], "n int, fire_id string")
    assert {r.n: r.fire_id for r in fires.synthetic_fire_ids(df, ["n"]).collect()} == {1: "7", 2: "-1", 3: "-2"}


def test_neighbors_match_brute_force(spark):
    rng = np.random.default_rng(5)
    d = dt.datetime(2020, 1, 1)
    rows = [(d + dt.timedelta(hours=int(h)), int(x), int(y), "s", 1, float(i), i) for i, (h, x, y) in enumerate(
        zip(rng.integers(0, 4, 200) * 3, rng.integers(0, 9, 200), rng.integers(0, 9, 200)))]
    df = spark.createDataFrame(rows, "pass_datetime timestamp_ntz, cell_x long, cell_y long, satellite string, is_burning int, frp_peak double, i int")
    out = {r.i: r for r in satellite.burning_neighbors(df).collect()}
    passes = sorted({r[0] for r in rows})
    for r in rows:
        before = passes[passes.index(r[0]) - 1] if r[0] != passes[0] else None
        for radius in (1, 2):
            near = [o for o in rows if abs(o[1] - r[1]) <= radius and abs(o[2] - r[2]) <= radius]
            assert out[r[6]][f"burning_neighbors_r{radius}"] == sum(o[0] == r[0] for o in near) - 1
            assert out[r[6]][f"burning_neighbors_prev_r{radius}"] == sum(o[0] == before for o in near)


def test_risk_levels(spark):
    cases = [(0.0, 0), (0.19, 0), (0.2, 1), (0.39, 1), (0.4, 2), (0.59, 2), (0.6, 3), (0.79, 3), (0.8, 4), (1.0, 4)]
    df = spark.createDataFrame(cases, "p double, level int")
    assert df.where(fire.risk_level(F.col("p")) != F.col("level")).count() == 0


def test_time_rules(spark):
    df = spark.createDataFrame([("2024-05-01T10:20:30.1234567Z", "930"), (None, "5"), ("soon", "0")], "t string, hhmm string")
    r = df.select(time.incident_time(F.col("t")).cast("timestamp_ntz").alias("t"), time.pass_time(F.lit("2024-01-01").cast("date"), F.col("hhmm")).alias("p")).collect()
    assert r[0].t == dt.datetime(2024, 5, 1, 10, 20, 30, 123456) and r[1].t is None and r[2].t is None
    assert [x.p.strftime("%H%M") for x in r] == ["0930", "0005", "0000"]
    assert df.select(time.season(F.lit(None).cast("timestamp_ntz"))).first()[0] == "Spring"


def _visits(spark, seed, n):
    """Fires, which of them touch which cells, and what the cells saw; ids and times that repeat or are null."""
    rng = np.random.default_rng(seed)
    d = dt.datetime(2020, 1, 1)
    ids = [None if i % 19 == 0 else int(i % (n - 6)) for i in range(n)]
    lit = [None if i % 23 == 0 else d + dt.timedelta(days=int(x)) for i, x in enumerate(rng.integers(0, 400, n))]
    kinds = ["small", "large", None]
    burnt = [(i, f, day, kinds[i % 3]) for i, (f, day) in enumerate(zip(ids, lit))]
    touched = [(f, day, int(x), int(y)) for _, f, day, _ in burnt for x, y in rng.integers(0, 3, (int(rng.integers(0, 4)), 2))]
    seen = [(int(x), int(y), None if i % 41 == 0 else d + dt.timedelta(hours=12 * int(h)), None if i % 7 == 0 else float(i), None if i % 5 == 0 else float(i % 64))
            for i, (x, y, h) in enumerate(zip(rng.integers(0, 4, 300), rng.integers(0, 3, 300), rng.integers(0, 1100, 300)))]
    seen += seen[:40]
    make = spark.createDataFrame
    return (make(burnt, "i int, fire_id int, ignition_date timestamp_ntz, size_class string"),
            make(touched, "fire_id int, ignition_date timestamp_ntz, cell_x long, cell_y long"),
            make(seen, "cell_x long, cell_y long, datetime timestamp_ntz, frp_peak double, frp_cumulative double"))


def test_life_by_place_equals_a_row_per_fire_and_detection(spark):
    for seed in (1, 2):
        burnt, touched, seen = _visits(spark, seed, 90)
        pairs = touched.join(seen, ["cell_x", "cell_y"])
        want = sorted(map(str, fires.unify_fires(burnt, pairs).collect()))
        got = fires.unify_fires(burnt, touched, seen, ["cell_x", "cell_y"])
        assert sorted(map(str, got.collect())) == want and any("'detected'" in r for r in want)


def test_spans_of_places_meet_across_cells(spark):
    d = dt.datetime(2020, 1, 1)
    day = lambda x: d + dt.timedelta(days=x)
    burnt = spark.createDataFrame([(1, d, "small"), (2, day(1), "small"), (3, day(200), "large")], "fire_id int, ignition_date timestamp_ntz, size_class string")
    touched = spark.createDataFrame([(f, x) for f in (1, 2, 3) for x in (0, 1)], "fire_id int, cell_x long").join(burnt.select("fire_id", "ignition_date"), "fire_id")
    # one cell sees days 0 and 8, the other bridges them at 4; day 121 is past the first fire's window and within the second's
    seen = spark.createDataFrame([(0, day(0)), (0, day(8)), (1, day(4)), (0, day(121)), (1, day(205))], "cell_x long, datetime timestamp_ntz")
    seen = seen.select("*", F.lit(2.0).alias("frp_peak"), F.lit(3.0).alias("frp_cumulative"))
    out = {r.fire_id: r for r in fires.unify_fires(burnt, touched, seen, ["cell_x"]).collect()}
    assert out[1].extinguish_date == day(8) and out[1].viirs_detection_count == 3 and out[1].cumulative_frp == 9.0
    assert out[2].extinguish_date == day(8) and out[2].viirs_detection_count == 4
    assert out[3].detection_status == "coverage_gap" and out[3].peak_frp is None


def test_detections_are_read_once(spark):
    d = dt.datetime(2020, 1, 1)
    rows = [(i % 4, i % 3, 1, d.date(), "D" if i % 2 else "N", "s", "h", 300.0, 290.0, float(i), "0130") for i in range(24)]
    raw = spark.createDataFrame(rows, "cell_x long, cell_y long, grid_id long, acq_date date, daynight string, satellite string, confidence string, brightness double, bright_t31 double, frp double, acq_time string")
    out = satellite.gridded_satellite_table(raw)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "LocalTableScan" not in plan and out.count() == 24 / 2
