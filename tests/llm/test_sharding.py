
import pytest
from pyspark.sql import functions as F

from emberfield.llm.sharding import shard_by_bytes


def brute(rows, shards, tolerance):
    keyed = sorted((g if g is not None else -(1 << 62), d if d is not None else -(1 << 62), s) for d, g, s in rows)
    total = sum(s for *_, s in keyed)
    of_group, start, at = {}, {}, 0
    befores = []
    for g, _, s in keyed:
        of_group[g] = of_group.get(g, 0) + s
        start.setdefault(g, at)
        befores.append(at)
        at += s
    out, slots = [], {}
    for (g, d, s), before in zip(keyed, befores):
        before = start[g] if of_group[g] <= int(tolerance * total / shards) else before
        k = before * shards // total
        out.append((g, d, s, k, slots.setdefault(k, 0)))
        slots[k] += 1
    return out


@pytest.mark.parametrize("shards,tolerance,per_task", [(24, 0.02, 20_000), (5, 0.5, 10), (7, 0.0, 3)])
def test_against_sorting_everything(spark, shards, tolerance, per_task):
    rows = [(i, i * 7919 % 61 if i % 3 else 7, 8 + i * 31 % 97) for i in range(400)]  # a third in one group
    rows += [(None, None, 9), (1000, None, 10), (1001, 5, 50_00)]
    df = spark.createDataFrame(rows, "doc_id long, g long, s long").withColumns({"shard": F.lit("x"), "fine": F.lit("x")})
    got = shard_by_bytes(df, F.col("g"), F.col("doc_id"), F.col("s"), shards, tolerance, per_task, cells=8)
    null = lambda v: v if v is not None else -(1 << 62)
    assert sorted((null(r.g), null(r.doc_id), r.s, r.shard, r.slot) for r in got.collect()) == sorted(brute(rows, shards, tolerance))


def test_repeated_rows_are_cut_too(spark):
    rows = [(1, 1, 10)] * 100 + [(2, 2, 10)] * 20
    got = shard_by_bytes(spark.createDataFrame(rows, "doc_id long, g long, s long"), F.col("g"), F.col("doc_id"), F.col("s"), 4, 0.02).collect()
    assert len(got) == 120
    assert sorted(sum(r.size for r in got if r.shard == k) for k in range(4)) == [300] * 4
    for k in range(4):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(30))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, g long, s long")
    assert shard_by_bytes(df, F.col("g"), F.col("doc_id"), F.col("s")).count() == 0
