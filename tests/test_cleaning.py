"""Cleaning, interpolation and scaling against hand-derived answers."""

import pytest
from pyspark.sql import functions as F

from emberfield.operators import cleaning, scaling, sequences


@pytest.fixture(scope="module")
def rows(spark):
    data = [
        ("C001", "120.5", "31.0", "2020-01-04", "3"), ("C002", "80.0", None, "2020-01-05", "2"), ("C003", None, "28.0", "2020-01-06", "1"),
        ("C004", "60.0", "35.5", "2020-01-07", "4"), ("C004", "60.0", "35.5", "2020-01-07", "4"),
    ]
    return spark.createDataFrame(data, "cell_id string, elevation_m string, max_temp_c string, fire_start_date string, severity string")


SCHEMA = {"cell_id": "str", "elevation_m": "float", "max_temp_c": "float", "fire_start_date": "datetime", "severity": "int"}


def test_missing(rows):
    assert cleaning.remove_missing(rows).count() == 3
    filled = cleaning.remove_missing(rows, "fill", {"elevation_m": "0.0", "max_temp_c": "-999"})
    assert filled.where("max_temp_c = '-999'").count() == 1 and filled.dropna().count() == 5
    assert cleaning.remove_missing(rows, "drop", subset=["max_temp_c"]).where("cell_id = 'C003'").count() == 1
    with pytest.raises(ValueError, match="Unknown strategy"):
        cleaning.remove_missing(rows, "interpolate")
    with pytest.raises(ValueError, match="fill_value must be provided"):
        cleaning.remove_missing(rows, "fill")


def test_duplicates(rows):
    assert cleaning.remove_duplicates(rows).count() == 4
    assert cleaning.remove_duplicates(rows, keep=False).count() == 3
    assert cleaning.remove_duplicates(rows, ["cell_id"], "last", ["severity"]).count() == 4


def test_cast_is_all_or_nothing(rows):
    out, log = cleaning.cast_types(rows, {"severity": "int", "max_temp_c": "int", "absent": "float"})
    types = dict(out.dtypes)
    assert types["severity"] == "bigint" and types["max_temp_c"] == "string"
    assert any("not found" in line for line in log) and any("ERROR" in line for line in log)
    assert any("skipped" in line for line in cleaning.cast_types(rows, {})[1])


def test_clean(rows):
    out, report = cleaning.clean(rows, SCHEMA)
    assert out.count() == 2 and dict(out.dtypes)["fire_start_date"] == "timestamp_ntz"
    for part in ("original:", "final:", "[missing]", "[duplicates]", "[types]"):
        assert part in report


def test_interpolation_by_position(spark):
    df = spark.createDataFrame(
        [("A", "2024-01-01", 0.10), ("A", "2024-01-02", None), ("A", "2024-01-09", 0.30), ("B", "2024-01-01", None),
         ("B", "2024-01-02", 0.5), ("B", "2024-01-03", None), ("B", "2024-01-04", 0.7), ("B", "2024-01-05", None)],
        "cell string, day string, v double")
    for block in (1, 2, 100_000):
        def values(direction):
            out = sequences.interpolate_time_series(df, "day", ["v"], ["cell"], direction, block=block).orderBy("cell", "day")
            return [None if r.v is None else round(r.v, 9) for r in out.collect()]

        assert values("forward") == [0.1, 0.2, 0.3, None, 0.5, 0.6, 0.7, 0.7]
        assert values("backward") == [0.1, 0.2, 0.3, 0.5, 0.5, 0.6, 0.7, None]
        assert values("both") == [0.1, 0.2, 0.3, 0.5, 0.5, 0.6, 0.7, 0.7]
    with pytest.raises(KeyError, match="time column"):
        sequences.interpolate_time_series(df, "timestamp", ["v"])
    with pytest.raises(KeyError):
        sequences.interpolate_time_series(df, "day", ["w"])


def test_scaling(spark):
    df = spark.createDataFrame([(30.0, -1.0, 5.0), (40.0, 0.0, 5.0), (50.0, 1.0, 5.0)], "t double, n double, flat double")
    out, params = scaling.scale_features(df, ["t", "flat"])
    assert params.first()["t_mean"] == 40.0
    assert abs(out.agg(F.avg("t_standard")).first()[0]) < 1e-9
    assert {r.flat_standard for r in out.collect()} == {0.0}
    out, params = scaling.scale_features(df, ["n"], "minmax")
    assert sorted(r.n_minmax for r in out.collect()) == [0.0, 0.5, 1.0] and params.first()["n_max"] == 1.0
    with pytest.raises(ValueError, match="method must"):
        scaling.scale_features(df, ["t"], "robust")


def test_one_series_of_200_000_rows_in_linear_time(spark):
    import time

    df = spark.range(200_000).select("id", F.when(F.col("id") % 1000 == 7, F.col("id").cast("double")).alias("v"))
    began = time.time()
    for direction, least, most in (("forward", 7.0, 199_007.0), ("backward", 7.0, 199_007.0)):
        out = sequences.interpolate_time_series(df, "id", ["v"], [], direction)
        r = out.agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), F.count_if((F.col("v") - F.col("id")).between(-1e-6, 1e-6)).alias("on_line")).first()
        assert (r.low, r.high, r.on_line) == (least, most, 199_001)
        assert r.n == (200_000 - 7 if direction == "forward" else 199_008)
    assert time.time() - began < 60


def test_spans_of_blocks(spark):
    df = spark.range(3_000).select("id", F.when(F.col("id").isin(5, 2_900), F.col("id").cast("double")).alias("v"))
    out = sequences.interpolate_time_series(df, "id", ["v"], [], "both", block=2)  # 1500 blocks: more than a span
    assert out.where(F.abs(F.col("v") - F.greatest(F.lit(5.0), F.least(F.lit(2900.0), F.col("id")))) > 1e-6).count() == 0
    assert out.where("v is null").count() == 0
