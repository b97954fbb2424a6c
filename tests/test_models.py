"""Metrics, splits, sequences and global ordering on small known cases."""

import pytest
from pyspark.sql import functions as F

from emberfield.operators import metrics, ordering, sequences, splits


@pytest.fixture(scope="module")
def pred(spark):
    return spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.3), (1, 0.2), (0, 0.1)], "y int, p double")


def test_ranking_with_ties(pred):
    r = metrics.compute_metrics(pred, "y", "p", 0.5).first()
    # average precision: 1/3 * 1 + 1/3 * 2/3 + 1/3 * 3/5; ROC area counts the tied pair half
    assert abs(r.pr_auc - (1 + 2 / 3 + 3 / 5) / 3) < 1e-12
    assert abs(r.roc_auc - (3 + 2.5 + 1) / 9) < 1e-12
    assert (r.tp, r.fp, r.fn, r.tn) == (2, 1, 1, 2) and not r.degenerate


def test_one_class_is_degenerate(pred):
    only = pred.where("y = 0")
    r = metrics.compute_metrics(only, "y", "p", 0.5).first()
    assert r.degenerate and r.precision is None and r.pr_auc is None and r.roc_auc is None and r.f2 is None
    t = metrics.find_best_threshold(only, "y", "p").first()
    assert t.threshold == 0.5 and t.f2 is None


def test_threshold_is_inclusive_and_lowest_wins(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.4)], "y int, p double")
    assert metrics.confusion_counts(df, "y", "p", 0.5).first().tp == 1
    assert metrics.find_best_threshold(df, "y", "p").first().threshold == 0.5


def test_shape_mismatch_raises(spark):
    cells = spark.createDataFrame([(1,), (2,)], "c int")
    with pytest.raises(ValueError, match="mismatch"):
        metrics.flatten_valid(cells.withColumn("p", F.lit(0.1)), cells.where("c = 1").withColumn("y", F.lit(1)), cells, ["c"], ["c"])


def test_empty_report_raises(pred):
    with pytest.raises(ValueError):
        metrics.classification_report(pred.where("y > 5"), "y", "p")


def test_subsample_is_exact_and_repeatable(spark):
    df = spark.range(1000).select("id", (F.col("id") % 100 == 0).cast("int").alias("label"))
    one = splits.negative_subsample(df, "label", ["id"], 20)
    assert one.where("label = 1").count() == 10 and one.where("label = 0").count() == 200
    again = splits.negative_subsample(df.repartition(5), "label", ["id"], 20)
    assert one.exceptAll(again).count() == 0


def test_noon_of_the_last_validation_day_is_in_no_split(spark):
    df = spark.sql("SELECT timestamp_ntz'2021-06-30 12:00:00' AS ts")
    assert df.select(splits.time_split_dates(F.col("ts"))).first()[0] is None
    assert df.select(splits.time_split_dates(F.col("ts"), close_gap=True)).first()[0] == "val"


def test_sequences(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(5)] + [("b", 1, 1.0)], "k string, t int, v double")
    rows = sequences.last_n_sequence(df, "k", "t", ["v"], 3).collect()
    assert [(r.k, r.observations) for r in rows] == [("a", [[2.0], [3.0], [4.0]])]
    with pytest.raises(ValueError):
        sequences.last_n_sequence(df.withColumn("v", F.when(F.col("t") != 4, F.col("v"))), "k", "t", ["v"], 3, strict=True)
    with pytest.raises(ValueError):
        sequences.last_n_sequence(df, "k", "t", ["v"], 9, strict=True)
    short = spark.createDataFrame([([[1.0]],), ([[1.0], [2.0], [3.0]],)], "s array<array<double>>")
    assert [r[0] for r in short.select(sequences.pad_or_truncate(F.col("s"), 2, 1)).collect()] == [[[0.0], [1.0]], [[2.0], [3.0]]]
    w = sequences.sliding_windows(df, ["k"], "t", ["v"], 2, 1).orderBy("sample").collect()
    assert [r["sample"] for r in w] == [0, 1, 2] and w[0].x == [[0.0], [1.0]] and w[0].y == [[2.0]]


def test_global_order_with_one_hot_key(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 4000, 7).otherwise(F.col("id")).alias("k"), "id")
    ids = ordering.number_rows(df, ["k", "id"], "n")
    want = [r.id for r in df.orderBy("k", "id").collect()]
    assert [r.id for r in ids.orderBy("n").collect()] == want and ids.agg(F.min("n"), F.max("n")).first() == (1, 5000)
    sums = ordering.running_sums(df, ["k", "id"], {"c": "k"}).orderBy("k", "id").collect()
    total = 0
    for r in sums:
        total += r.k
        assert r.c == total
    prev = {r.id: r.p for r in ordering.previous_row(df, ["id"], {"p": "id"}, 6).collect()}
    assert prev[5] is None and prev[6] == 0 and prev[4999] == 4993
    q = {r.probability: r.quantile for r in ordering.exact_quantiles(df.select((F.col("id") * 1.0).alias("v")), "v", [0.0, 0.25, 1.0]).collect()}
    assert q == {0.0: 0.0, 0.25: 1249.75, 1.0: 4999.0}


@pytest.mark.parametrize("sorted_rows", [1, 50, 20_000])
def test_first_rows_by_counting(spark, sorted_rows):
    import random

    rng = random.Random(sorted_rows)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice([rng.randint(-(1 << 63), (1 << 63) - 1), rng.randint(-3, 3), 7, None])) for i in range(2_000)]
    df = spark.createDataFrame(rows, "id long, g string, o long").repartition(4)
    wanted = {"a": 300, "b": 0, None: 100_000}
    first, rest = ordering.first_rows(df, [F.col("o")], ["id"], wanted, "g", sorted_rows)
    key = lambda r: (r[2] is not None, r[2] or 0, r[0])
    want = {r[0] for g, n in wanted.items() for r in sorted((r for r in rows if r[1] == g), key=key)[:n]}
    assert sorted(r.id for r in first.collect()) == sorted(want)
    assert sorted(r.id for r in rest.collect()) == sorted({r[0] for r in rows} - want)


def test_negatives_are_not_sorted(spark):
    df = spark.range(300_000).select("id", (F.col("id") % 10_000 == 5).cast("int").alias("y"))
    out = splits.negative_subsample(df, "y", ["id"], ratio=3)
    assert out.groupBy("y").count().orderBy("y").collect() == [(0, 90), (1, 30)]
    h = F.xxhash64(F.lit(42), "id")
    want = {r.id for r in df.where("y = 0").orderBy(h).limit(90).collect()}
    assert {r.id for r in out.where("y = 0").collect()} == want
    split = splits.stratified_split(df, "y", ["id"])
    assert sorted(map(tuple, split.groupBy("y", "split").count().collect())) == [(0, "train", 269_973), (0, "val", 29_997), (1, "train", 27), (1, "val", 3)]
    empty = splits.negative_subsample(df.limit(0), "y", ["id"])
    assert empty.count() == 0 and splits.stratified_split(df.limit(0), "y", ["id"]).count() == 0


@pytest.mark.parametrize("order", [None, "w"])
def test_subsample_per_group(spark, order):
    df = spark.range(300).select("id", (F.col("id") % 3).alias("g"), F.when((F.col("id") < 12) & (F.col("id") % 3 > 0), 1).otherwise(0).alias("y"), (-F.col("id") / 7.0).alias("w"))
    out = splits.negative_subsample(df, "y", ["id"], 5, order=order and [F.col(order)], by="g").collect()
    assert {g: sum(r.g == g and r.y == 0 for r in out) for g in (0, 1, 2)} == {0: 0, 1: 20, 2: 20}
    assert sum(r.y for r in out) == 8
    if order:
        assert min(r.id for r in out if r.y == 0 and r.g == 1) == 298 - 19 * 3


def test_samples_meet_their_rows_without_a_join(spark):
    """A join of the copied anchors was broadcast, whatever they came to once copied; an anchor asked for twice got each step twice."""
    rows = spark.range(1400).select((F.col("id") % 2).alias("c"), F.floor(F.col("id") / 2).alias("t"), F.col("id").alias("v"))
    wanted = [(0, 1), (0, 255), (0, 256), (0, 300), (0, 300), (0, 512), (0, 700), (1, 0), (1, 60), (2, 60), (None, 60)]
    anchors = spark.createDataFrame([(c, i, 1) for c, i in wanted], "c long, idx long, y int")
    out = sequences.materialize_samples(anchors, rows, "c", "t", ["v"], "y", 60)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    got = {(r.c, r.anchor): [s[0] for s in r.x] for r in out.collect()}
    assert got == {(c, i): [2.0 * k + c for k in range(max(0, i - 60), i)] for c, i in wanted if c in (0, 1) and i}
