"""The whole jobs on small inputs."""

import datetime as dt

from pyspark.sql import functions as F

from emberfield.functions import fire
from emberfield.operators import scaling
from emberfield.plans import bindings, jobs


def test_hub_and_spoke(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    (src / "fire_sample.csv").write_text(
        "incident_id,original_latitude,original_longitude,confidence_score,source_system,datetime_record\n"
        "1,-37.81,145.09,80,X,2024-01-01 05:30:00\n2,-33.0,151.2,70,X,2024-01-01 06:30:00\n3,-36.8,144.3,60,X,2024-01-01 05:59:59\n")
    (src / "weather_sample.csv").write_text(
        "weather_id,original_latitude,original_longitude,temperature_c,wind_speed_kmh,relative_humidity,source_system,datetime_record\n"
        "1,-37.82,145.08,30,10,40,Y,2024-07-01 01:00:00\n")
    (src / "topography_sample.csv").write_text("topo_id,original_latitude,original_longitude,elevation_m,slope_angle\n1,-38.2,144.4,5,1\n")
    report = {(r.kind, r.name): r.rows for r in jobs.load_hub_and_spoke(spark, str(src), str(out), order="first_seen").collect()}
    assert report[("input", "fire")] == 3 and report[("output", "fire")] == 2 and report[("output", "vegetation")] == 0
    assert report[("registry", "location_ids")] == 3 and report[("registry", "time_ids")] == 2
    cells = {r.region_name: r.location_id for r in spark.read.csv(str(out / "location_registry"), header=True).collect()}
    assert cells == {"Melbourne": "1", "Bendigo": "2", "Geelong": "3"}
    seasons = {r.season for r in spark.read.csv(str(out / "time_registry"), header=True).collect()}
    assert seasons == {"Summer", "Winter"}


def test_satellite_to_fire_history(spark):
    d = dt.date(2020, 1, 1)
    rows = [(-37.0, 145.0 + 0.001 * i, d + dt.timedelta(days=i), "0130", "N", "D", "h", 300.0, 290.0, 5.0) for i in range(3)]
    rows.append((-20.0, 130.0, d, "0130", "N", "D", "h", 300.0, 290.0, 5.0))
    det = spark.createDataFrame(rows, "latitude double, longitude double, acq_date date, acq_time string, satellite string, daynight string, "
                                      "confidence string, brightness double, bright_t31 double, frp double")
    boundary = spark.range(1).select(bindings.diamond(F.lit(145.0), F.lit(-37.0), F.lit(3.0)).alias("rings"))
    table = jobs.satellite_history(det, boundary, (15600000.0, -4900000.0))
    assert table.count() == 3 and abs(table.first().latitude + 37.0) < 0.05
    shapes = spark.createDataFrame([(1, dt.datetime(2020, 1, 1), 50.0)], "fire_id int, ignition_date timestamp_ntz, area_ha double").select(
        "*", fire.size_class(F.col("area_ha")).alias("size_class"), bindings.diamond(F.lit(145.0), F.lit(-37.0), F.lit(0.05)).alias("rings"))
    unified, daily = jobs.unified_fire_history(shapes, table, (15600000.0, -4900000.0))
    r = unified.first()
    assert r.viirs_detection_count == 3 and r.detection_status == "detected" and r.extinguish_date == dt.datetime(2020, 1, 3, 1, 30)
    assert daily.count() == 3


def test_risk_map(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    times = spark.createDataFrame([(i, t0 + dt.timedelta(hours=i)) for i in range(4)], "time_id int, datetime_record timestamp_ntz")
    locs = spark.createDataFrame([(1, -37.0, 145.0, 0, 0, "a"), (2, -37.5, 145.5, 1, 0, "b")],
                                 "location_id int, grid_latitude double, grid_longitude double, grid_row int, grid_col int, region_name string")
    weather = spark.createDataFrame([(loc, i, float(loc * i)) for loc in (1, 2) for i in range(4)], "location_id int, time_id int, v double")
    out = jobs.forecast_risk_map(weather, locs, times, ["v"], scaling.fit_scaler(weather, ["v"]),
                                 lambda batch: [[0.9 if seq[-1][0] > 1 else 0.1] for seq in batch], 3, str(tmp_path / "map"))
    assert {r.location_id: r.risk_factor for r in out.collect()} == {1: 5, 2: 1}
    assert spark.read.parquet(str(tmp_path / "map")).count() == 2


def test_training_samples_stay_within_their_split(spark, tmp_path):
    t0 = dt.datetime(2020, 12, 29)
    env = [(x, 0, t0 + dt.timedelta(hours=12 * i), float(i)) for x in (0, 1) for i in range(12)]
    env += [(0, 0, t0, 99.0), (0, 0, t0 + dt.timedelta(days=60), None), (7, 7, t0, 5.0)]  # an overlapping export, a gap, a short series
    table = spark.createDataFrame(env, "cell_x long, cell_y long, datetime timestamp_ntz, v double")
    days = [(dt.datetime(2020, 12, 30), 1), (dt.datetime(2021, 1, 2), 0), (dt.datetime(2021, 1, 2), 0)]
    outlines = spark.createDataFrame([(*d, 1) for d in days], "date timestamp_ntz, daynight int, is_burning int").select(
        "*", bindings.diamond(F.lit(0.5), F.lit(0.5), F.lit(0.1)).alias("rings"))
    samples, scaler = jobs.training_samples(table, outlines, ["v"], (1.0, (0.0, 0.0)), str(tmp_path), lookback=2, ratio=2)
    got = {(r.split, r.cell_x, r.anchor, r.is_burning): [s[0] for s in r.x] for r in samples.collect()}
    # six half days of 2020 train, six of 2021 validate; a window starts anew in each split
    mean, spread = 2.5, (35 / 12) ** 0.5
    p = scaler.first()
    assert abs(p.v_mean - mean) < 1e-12 and abs(p.v_std - spread) < 1e-12
    assert got[("train", 0, 3, 1)] == [(1 - mean) / spread, (2 - mean) / spread]
    assert got[("val", 0, 2, 1)] == [(6 - mean) / spread, (7 - mean) / spread]
    assert sorted((s, y) for s, _, _, y in got) == [("train", 0), ("train", 0), ("train", 1), ("val", 0), ("val", 0), ("val", 1)]


def test_evaluation_uses_the_threshold_of_validation(spark):
    # 20 times: 15 train, 3 validate, 2 test; cell 2 has no input
    rows = [(t, c, 0.8 if (t + c) % 2 else (0.6 if t == 17 else 0.2), (t + c) % 2) for t in range(20) for c in (0, 1, 2)]
    table = spark.createDataFrame(rows, "t long, c long, p double, is_burning int")
    inputs = spark.createDataFrame([(0, 1.0), (1, 1.0), (2, None)], "c long, v double")
    r = jobs.evaluate_forecast(table.select("t", "c", "p"), table.select("t", "c", "is_burning"), inputs, "t", ["c"], ["v"]).first()
    assert r.threshold == 0.8 and (r.n_cells, r.tp, r.fp, r.fn, r.tn) == (4, 2, 0, 0, 2)
    assert r.pr_auc == 1.0 and r.base_rate == 0.5 and abs(r.always_positive_f2 - 2.5 / 3) < 1e-9


def test_fires_and_detections_of_a_cell_are_not_multiplied(spark, monkeypatch):
    d = dt.datetime(2020, 1, 1)
    seen = spark.range(60).select(F.lit(100).cast("long").alias("cell_x"), F.lit(20).cast("long").alias("cell_y"), (F.lit(d) + F.make_dt_interval(F.lit(0), (F.col("id") * 12).cast("int"))).cast("timestamp_ntz").alias("datetime"),
                                  F.lit(0).alias("daynight"), F.lit("N").alias("satellite"), F.lit(2.0).alias("frp_peak"), F.lit(3.0).alias("frp_cumulative"), F.lit(145.0).alias("longitude"), F.lit(-37.0).alias("latitude"))
    corner = (15600000.0, -4900000.0)
    lon, lat = ((F.lit(v + 2500.0) for v in (corner[0] + 100 * 5000, corner[1] + 20 * 5000)))
    from emberfield.functions import grid
    shapes = spark.range(50).select(F.col("id").alias("fire_id"), F.lit(d).cast("timestamp_ntz").alias("ignition_date"), F.lit(50.0).alias("area_ha"), F.lit("medium").alias("size_class"),
                                    bindings.diamond(grid.mercator_lon(lon), grid.mercator_lat(lat), F.lit(0.01)).alias("rings"))
    stored, real = [], jobs.durable
    monkeypatch.setattr(jobs, "durable", lambda df: (lambda out: stored.append(out.count()) or out)(real(df)))
    unified, daily = jobs.unified_fire_history(shapes, seen, corner)
    assert max(stored) <= 50  # not 50 fires x 60 detections
    rows = unified.collect()
    assert len(rows) == 50 and {(r.viirs_detection_count, r.cumulative_frp, r.extinguish_date) for r in rows} == {(60, 180.0, d + dt.timedelta(hours=12 * 59))}
    assert daily.count() == 30
