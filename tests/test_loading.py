"""Load rules, run log, readers and streams."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from emberfield import schemas
from emberfield.operators import narratives, quality
from emberfield.sources import readers, sinks
from emberfield.sources.idindex import IdIndex
from emberfield.streaming import streams


def test_append_is_idempotent_and_nulls_never_conflict(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (2, None, 3)], "k int, s string, v int")
    assert sinks.append_new_by_key(batch, path, ["k", "s"], ["v"]) == {"fetched": 3, "inserted": 2, "skipped": 1}
    assert sinks.append_new_by_key(batch.where("s is not null"), path, ["k", "s"])["inserted"] == 0
    assert sinks.append_new_by_key(batch.where("s is null"), path, ["k", "s"])["inserted"] == 1
    assert spark.read.parquet(path).where("s = 'a'").first().v == 1


def test_partitioned_append(spark, tmp_path):
    path = str(tmp_path / "p")
    def rows(*days):
        return spark.createDataFrame([(i, dt.date(2024, 1, d)) for i, d in enumerate(days)], "k int, day date")

    assert sinks.append_new_by_key(rows(1, 2), path, ["k", "day"], partition="day")["inserted"] == 2
    assert sinks.append_new_by_key(rows(1, 3), path, ["k", "day"], partition="day")["inserted"] == 1


def test_upsert_takes_the_last(spark):
    target = spark.createDataFrame([(1.0, 2.0, "old"), (3.0, 4.0, "kept")], "grid_latitude double, grid_longitude double, region_name string")
    batch = spark.createDataFrame([(1.0, 2.0, "x", 1), (1.0, 2.0, "y", 2), (5.0, 6.0, "new", 3)], "grid_latitude double, grid_longitude double, region_name string, n int")
    out = {r.grid_latitude: r.region_name for r in sinks.upsert_location(target, batch, "n").collect()}
    assert out == {1.0: "y", 3.0: "kept", 5.0: "new"}


def test_upsert_replaces_only_the_buckets_of_its_keys(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k long, v string"
    whole = spark.range(2000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    sinks.store_in_buckets(whole, path, ["k"], 16)

    def files():
        return {f for f in spark.read.parquet(path).inputFiles()}

    before = files()
    batch = spark.createDataFrame([(3, "a", 1), (3, None, 2), (2500, "new", 1)], "k long, v string, n int")
    touched = sinks.upsert_table(batch, path, schema, ["k"], "v", "n", 16)
    changed = {f.split("bucket=")[1].split("/")[0] for f in before ^ files()}
    assert changed == {str(b) for b in touched} and len(touched) <= 2
    got = {r.k: r.v for r in sinks.read_buckets(spark, path, schema).collect()}
    assert got == {**{k: "old" for k in range(2000)}, 3: None, 2500: "new"}
    assert sinks.upsert_table(batch.limit(0), path, schema, ["k"], "v", "n", 16) == [] and files() ^ before


def test_broken_off_upsert_is_finished_by_the_next(spark, tmp_path):
    path, schema = tmp_path / "t", "k long, v string"
    rows = lambda v: spark.range(100).select(F.col("id").alias("k"), F.lit(v).alias("v"))
    sinks.store_in_buckets(rows("old"), str(path), ["k"], 4)
    sinks.store_in_buckets(rows("new"), f"{path}.merging", ["k"], 4)  # as after the last write, before any bucket is moved
    next((path / "..").resolve().glob("t/bucket=2")).rename(tmp_path / "gone")  # and one deleted, not yet replaced
    sinks.upsert_table(spark.createDataFrame([(5, "x", 1)], "k long, v string, n int"), str(path), schema, ["k"], "v", "n", 4)
    got = {r.k: r.v for r in sinks.read_buckets(spark, str(path), schema).collect()}
    assert got == {**{k: "new" for k in range(100)}, 5: "x"} and not (tmp_path / "t.merging").exists()


def test_append_counts_while_it_writes(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def once(rows):
        for b in rows:
            seen.add(b.num_rows)
            yield b

    batch = spark.range(50, numPartitions=2).mapInArrow(once, "id long")
    assert sinks.append_new_by_key(batch, str(tmp_path / "a"), ["id"]) == {"fetched": 50, "inserted": 50, "skipped": 0}
    assert seen.value == 50  # the input was evaluated once
    assert sinks.append_new_by_key(batch.where("id < 0"), str(tmp_path / "a"), ["id"]) == {"fetched": 0, "inserted": 0, "skipped": 0}
    empty = spark.createDataFrame([], "id long")
    assert sinks.append_new_by_key(empty, str(tmp_path / "a"), ["id"]) == {"fetched": 0, "inserted": 0, "skipped": 0}


def test_replace_table_can_read_itself(spark, tmp_path):
    path = str(tmp_path / "r")
    sinks.append(spark.range(10), path)
    sinks.replace_table(spark.read.parquet(path).where("id > 6"), path)
    assert spark.read.parquet(path).count() == 3


def test_missing_csv_is_empty(spark, tmp_path):
    df = readers.read_csv_typed(spark, str(tmp_path / "absent.csv"), schemas.FIRE)
    assert df.count() == 0 and "incident_id" in df.columns


def test_daily_and_year_files(spark, tmp_path):
    head = "latitude,longitude,brightness,scan,track,acq_date,acq_time,satellite,instrument,confidence,version,bright_t31,frp,daynight"
    day = tmp_path / "2019"
    day.mkdir()
    for n, lat in ((1, -37.0), (3, 5.0)):
        (day / f"{n:03d}.csv").write_text(f"{head}\n{lat},145,300,1,1,2019-01-0{n},0100,T,MODIS,50,6,290,5,D\n")
    assert readers.read_firms_daily(spark, str(tmp_path), 2019, 1, 4).count() == 1
    for name in ("env_2018.csv", "jan_2018.csv", "era5land_2018.csv"):
        (tmp_path / name).write_text("a\n1\n")
    assert readers.read_year_file(spark, str(tmp_path), 2018, "a INT").count() == 1
    (tmp_path / "second_2018.csv").write_text("a\n1\n")
    with pytest.raises(FileNotFoundError):
        readers.read_year_file(spark, str(tmp_path), 2018, "a INT")
    for name in ("part1.csv", "._part2.csv"):
        (day / name).write_text("a\n1\n")
    assert readers.read_year_chunks(spark, str(day), "a INT").count() >= 1


def test_json_single_object_and_list(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"a": 1}')
    (tmp_path / "two.json").write_text('[{"a": 1},\n {"a": 2}]')
    assert readers.read_json_records(spark, str(tmp_path / "one.json"), "a INT").count() == 1
    assert readers.read_json_records(spark, str(tmp_path / "two.json"), "a INT").count() == 2


def test_label_table_is_strict(spark):
    df = spark.createDataFrame([("a", "0"), ("b", "7")], "text string, label string")
    assert readers.load_label_table(df.where("label = '0'"), "text", "label", [0, 1]).first().label == 0
    with pytest.raises(Exception, match="allowed set"):
        readers.load_label_table(df, "text", "label", [0, 1]).collect()
    with pytest.raises(ValueError):
        readers.load_label_table(df, "text", "target", [0, 1])


def test_run_log(spark, tmp_path):
    run = sinks.RunLog(spark, str(tmp_path / "log"), "hotspots")
    run.start(["a", "b"])
    assert run.finish([], {}) == "PARTIAL"
    assert sinks.run_states(spark.read.schema(schemas.RUN_LOG).parquet(str(tmp_path / "log"))).first().status == "PARTIAL"


def _collection(factor):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    return json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [ring]}, "properties": {"risk_factor": factor}}]})


def test_snapshot_ignores_invalid_payloads(spark):
    df = spark.createDataFrame([(1, _collection(2)), (2, _collection(9)), (3, "null"), (4, "{bad")], "n int, payload string")
    assert [r.risk_factor for r in sinks.latest_snapshot(df, "payload", ["n"]).collect()] == [2]
    assert sinks.latest_snapshot(df.where("n > 1"), "payload", ["n"]).count() == 0
    assert sinks.read_snapshot(spark, "/tmp/emberfield-absent", "risk_factor INT").count() == 0


def test_upsert_with_null_and_unequal_doubles(spark):
    target = spark.createDataFrame([(0.3, 2.0, "old"), (3.0, 4.0, "kept")], "grid_latitude double, grid_longitude double, region_name string")
    batch = spark.createDataFrame([(0.1 + 0.2, 2.0, None, 1)], "grid_latitude double, grid_longitude double, region_name string, n int")
    out = {r.grid_latitude: r.region_name for r in sinks.upsert_location(target, batch, "n").collect()}
    assert out == {0.3: None, 3.0: "kept"}


def test_broken_off_replacement_leaves_the_table(spark, tmp_path):
    path = tmp_path / "t"
    sinks.append(spark.range(3), str(path))
    path.rename(str(path) + ".previous")  # as after the first of the two renames
    assert sinks.read_table(spark, str(path), "id bigint").count() == 3
    sinks.replace_table(spark.range(5), str(path))
    assert sinks.read_table(spark, str(path), "id bigint").count() == 5 and not (tmp_path / "t.previous").exists()


def test_append_reads_only_the_partitions_it_touches(spark, tmp_path):
    path = str(tmp_path / "days")
    days = spark.createDataFrame([(i, dt.date(2024, 1, 1 + i % 20)) for i in range(40)], "k int, day date")
    sinks.append_new_by_key(days, path, ["k", "day"], partition="day")
    batch = spark.createDataFrame([(1, dt.date(2024, 1, 2)), (100, dt.date(2024, 1, 20))], "k int, day date")
    plan = sinks.read_table(spark, path, batch.schema).where(sinks.present_values(batch, "day"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [day#" in plan and "IN (2024-01-02,2024-01-20)" in plan.replace("in (", "IN (") or "InSet" in plan
    assert sinks.append_new_by_key(batch, path, ["k", "day"], partition="day") == {"fetched": 2, "inserted": 1, "skipped": 1}


def _stream_two(spark, src, schema, fmt="csv", **options):
    return streams.file_stream(spark, str(src), fmt, schema, maxFilesPerTrigger=1, **options)


def _in_order(src, *texts, suffix="csv"):
    import os

    src.mkdir()
    for i, text in enumerate(texts):
        f = src / f"{i}.{suffix}"
        f.write_text(text)
        os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))


def test_hotspot_stream_replay_and_late_rows(spark, tmp_path):
    src, paths = tmp_path / "in", [str(tmp_path / n) for n in ("table", "late", "log")]
    head = "latitude,longitude,acq_date,acq_time,satellite,frp"
    row = "-37.81,144.96,2024-01-10,130,N,5"
    # the old row comes in a batch of its own, where nothing is newer
    _in_order(src, f"{head}\n{row}\n{row}\n", f"{head}\n-37.5,148.2,2024-01-01,10,N,1\n")
    schema = ", ".join(f"{c} STRING" for c in head.split(","))
    for checkpoint in ("c1", "c2"):  # a second run without memory of the first must add nothing
        streams.hotspot_stream(
            _stream_two(spark, src, schema, header="true"), *paths, str(tmp_path / checkpoint), delay_days=3, reference=dt.datetime(2024, 1, 10)
        ).awaitTermination()
    table = spark.read.parquet(paths[0]).collect()
    assert [r.region_name for r in table] == ["Melbourne Metro"] and spark.read.parquet(paths[1]).count() == 1
    with pytest.raises(ValueError):
        streams.hotspot_stream(_stream_two(spark, src, schema), *paths, str(tmp_path / "c3"), delay_days=3)


def _feature_doc(feats):
    return json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "geometry": {"type": "Point", "coordinates": at}, "properties": {"id": i, "feedType": f, "category1": c, "created": u, "updated": u}}
        for i, f, c, u, at in feats]})


def test_incident_stream_keeps_old_incidents_of_later_batches(spark, tmp_path):
    here = [145.0, -37.0]
    new = [
        ("1", "Incident", "Fire", "2024-06-01T00:00:00Z", here), ("1", "Incident", "Fire", "2024-06-01T00:00:00Z", here),
        ("2", "Incident", "Flood", "2024-06-01T00:00:00Z", here), ("3", "warning", "Fire", "2024-06-01T00:00:00Z", here)]
    old = [("4", "INCIDENT", "Bushfire", "2024-01-02T00:00:00Z", [10.0, 10.0]), ("1", "Incident", "Fire", "2024-01-01T00:00:00Z", here)]
    _in_order(tmp_path / "in", _feature_doc(new), _feature_doc(old), suffix="json")
    registry = spark.createDataFrame([(7, -37.001, 145.001)], "location_id long, grid_latitude double, grid_longitude double")
    stream = _stream_two(spark, tmp_path / "in", schemas.INCIDENT_FEATURES, "json")
    streams.incident_stream(stream, registry, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    assert {r.id: r.location_id for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {"1": 7, "4": None}


def test_half_day_means_take_late_rows(spark, tmp_path):
    head = "k,ts,v"
    _in_order(
        tmp_path / "in", f"{head}\na,2024-01-01 01:00:00,1\na,2024-01-02 13:30:00,5\n",
        f"{head}\na,2024-01-01 02:00:00,3\nb,2023-12-01 00:00:00,9\n", f"{head}\na,2024-01-03 01:00:00,7\n")
    table = str(tmp_path / "means")
    stream = _stream_two(spark, tmp_path / "in", "k STRING, ts TIMESTAMP_NTZ, v DOUBLE", header="true")
    streams.env_12h_stream(stream, ["k"], "ts", ["v"], table, str(tmp_path / "c")).awaitTermination()
    got = {(r.k, str(r.interval_start)): r.v for r in spark.read.parquet(table).collect()}
    assert got == {("a", "2024-01-01 00:00:00"): 2.0, ("b", "2023-12-01 00:00:00"): 9.0, ("a", "2024-01-02 12:00:00"): 5.0}


def test_half_day_state_touches_its_days_only_and_survives_a_replay(spark, tmp_path):
    head = "k,ts,v"
    files = [f"{head}\na,2024-01-01 01:00:00,1\na,2024-01-02 13:30:00,5\n", f"{head}\na,2024-01-02 14:00:00,7\na,2099-01-01 00:00:00,1\n", f"{head}\na,2024-01-03 13:00:00,1\n"]
    table, state = tmp_path / "means", tmp_path / "means-state"

    def run():
        stream = _stream_two(spark, tmp_path / "in", "k STRING, ts TIMESTAMP_NTZ, v DOUBLE", header="true")
        streams.env_12h_stream(stream, ["k"], "ts", ["v"], str(table), str(tmp_path / "c"), latest=dt.datetime(2025, 1, 1)).awaitTermination()
        return {(r.k, str(r.interval_start)): r.v for r in spark.read.parquet(str(table)).collect()}

    def parts(day):
        return sorted(p.name for p in (state / f"day={day}").glob("*.parquet"))

    seen = []
    for i, text in enumerate(files):
        _in_order(tmp_path / "in", *files[: i + 1]) if not i else (tmp_path / "in" / f"9{i}.csv").write_text(text)
        got = run()
        seen.append((parts("2024-01-01"), parts("2024-01-02")))
    assert seen[0][0] == seen[1][0] == seen[2][0] and seen[0][1] != seen[1][1] == seen[2][1]
    # the far-off row is summed but ends no half day
    want = {("a", "2024-01-01 00:00:00"): 1.0, ("a", "2024-01-02 12:00:00"): 6.0}
    assert got == want
    last = max(int(p.name) for p in (tmp_path / "c" / "commits").iterdir() if p.name.isdigit())
    for p in (tmp_path / "c" / "commits").glob(f"*{last}*"):
        p.unlink()
    assert run() == want
    assert spark.read.parquet(str(state)).where("day = '2024-01-03'").first().sum_v == 1.0


def test_ids_are_looked_up_in_their_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda ids, u="2024": spark.createDataFrame([(i, u) for i in ids], "id string, updated string")
    first = sinks.insert_new_incidents(rows([str(i) for i in range(500)] + [None]), path)
    assert (first["inserted"], first["skipped"]) == (501, 0)
    index = IdIndex(spark, path)
    seen = index.seen(rows(["7", "900"]))
    assert [r.id for r in seen.collect()] == ["7"]
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    assert "PushedFilters: [In(id, [7,900])]" in plan or "PushedFilters: [Or(EqualTo(id,7),EqualTo(id,900))]" in plan or "In(id" in plan
    # without the ids themselves the buckets still bound what is read
    all_of = index.seen(rows(["7", "900"]), most=0).select("id", F.input_file_name().alias("f")).collect()
    assert "7" in {r.id for r in all_of} and len({r.f for r in all_of}) <= 2 and len(all_of) < 60
    again = sinks.insert_new_incidents(rows(["7", "900", "900"], "2020"), path)
    assert (again["inserted"], again["skipped"]) == (1, 2)
    # a load that broke off before the index was written is made up for
    rows(["1000"]).withColumn("location_id", F.lit(None).cast("long")).write.mode("append").parquet(path)
    assert sinks.insert_new_incidents(rows(["1000", "1001"]), path)["inserted"] == 1
    # a replaced table has its index built anew
    sinks.replace_table(spark.read.parquet(path).where("id = '7'"), path)
    assert sinks.insert_new_incidents(rows(["7", "8"]), path)["inserted"] == 1
    assert sinks.insert_new_incidents(rows([]), path)["inserted"] == 0


def test_snapshot_is_not_replaced_by_an_older_one(spark, tmp_path):
    src = tmp_path / "in"
    _in_order(src, json.dumps({"n": 2, "payload": _collection(4)}), json.dumps({"n": 1, "payload": _collection(2)}), suffix="json")
    stream = _stream_two(spark, src, "n INT, payload STRING", "json")
    streams.risk_snapshot_stream(stream, "payload", ["n"], str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    assert [r.risk_factor for r in spark.read.parquet(str(tmp_path / "t")).collect()] == [4]


def test_only_touched_days_are_made_again(spark, tmp_path):
    _in_order(tmp_path / "in", "day\n2024-01-02\n")
    table = str(tmp_path / "t")
    full = lambda s, n: s.createDataFrame([(dt.date(2024, 1, 1), n), (dt.date(2024, 1, 2), n)], "day date, n int")
    sinks.replace_partitions(full(spark, 1), table, "day")
    stream = _stream_two(spark, tmp_path / "in", "day DATE", header="true")
    streams.refresh_on_change(stream, lambda s: full(s, 2), table, str(tmp_path / "c"), "day", F.col("day")).awaitTermination()
    assert {r.day.day: r.n for r in spark.read.parquet(table).collect()} == {1: 1, 2: 2}


def test_ascii_lines_follow_file_order(spark, tmp_path):
    (tmp_path / "a.txt").write_text("K V\n" + "".join(f"a{i} 1\n" for i in range(50)))
    (tmp_path / "b.txt").write_text("".join(f"b{i} 1\n" for i in range(9000)))  # larger, so that Spark reads it first
    rows = readers.read_ascii_table(spark, str(tmp_path), ["K", "V"]).orderBy("line").collect()
    assert [r.K for r in rows] == [f"a{i}" for i in range(50)] + [f"b{i}" for i in range(9000)]


def test_lists_have_no_limit_and_a_long_form(spark):
    df = spark.range(20).select(F.lit(1).alias("k"), F.col("id"))
    assert narratives.nest(df, "k", [F.col("id")], F.col("id"), "ids").first().ids == list(range(20))
    posts = spark.range(5).select(F.col("id").alias("post_id"), (F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"))
    members = posts.select(F.lit(7).alias("cluster_id"), "post_id")
    claims = spark.createDataFrame([(7, 2, "b"), (7, 1, "a"), (8, 1, "c")], "narrative_cluster_id int, id int, content string")
    facts = spark.createDataFrame([(7, 1, "s", dt.datetime(2024, 1, 1), "old"), (7, 2, "s", dt.datetime(2024, 1, 2), "new")], "narrative_cluster_id int, id int, source string, timestamp timestamp_ntz, content string")
    rows = narratives.narrative_items(members, posts, claims, facts).collect()
    at = {(r.narrative_id, r.kind, r.position): r.content or r.item_id for r in rows}
    assert len(rows) == 10 and at[7, "claim", 1] == "a" and at[7, "fact", 1] == "new" and at[7, "post", 5] == 4 and at[8, "claim", 1] == "c"


def test_gates_raise(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    with pytest.raises(quality.QualityError):
        quality.unique_keys(df, ["k"], strict=True)
    with pytest.raises(quality.QualityError):
        quality.coverage_equal(df, df.where("k = 1"), ["k"])
    with pytest.raises(quality.QualityError):
        quality.target_schema(df, df, 1, 2)
    posts = spark.createDataFrame([(1,), (2,), (3,)], "post_id int")
    members = spark.createDataFrame([(10, 1), (11, 1), (10, 9)], "cluster_id int, post_id int")
    row = quality.narrative_output(posts, members).first()
    assert (row.unknown_posts, row.duplicate_posts, row.unassigned_posts) == (1, 1, 2)
