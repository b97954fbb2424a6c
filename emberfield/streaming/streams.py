"""Structured Streaming jobs. Every sink is idempotent, so a replayed batch adds nothing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from emberfield.functions import grid, time
from emberfield.operators import cleaning
from emberfield.operators.relational import incident_locations
from emberfield.session import durable
from emberfield.sources import readers, sinks


def file_stream(spark: SparkSession, folder: str, fmt: str, schema: str, pattern: str | None = None, **options) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder)


def _run(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def incident_stream(features: DataFrame, registry: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Incident feed files: fire incidents, once per id, with the nearest registry cell, appended.

    Ids are looked up in the table's index, so an incident is loaded however old it is and a batch reads only its own buckets.
    """
    incidents = cleaning.fire_incident_filter(readers.flatten_features(features))

    def each(batch: DataFrame, _: int) -> None:
        sinks.insert_new_incidents(batch, table, locate=lambda fresh: incident_locations(fresh, registry).drop("km"))

    return _run(incidents, checkpoint, each)


HOTSPOT_KEY = ["latitude", "longitude", "acq_date", "acq_time", "satellite"]


def hotspot_stream(
    hotspots: DataFrame,
    table: str,
    late_table: str,
    log_path: str,
    checkpoint: str,
    delay_days: int | None = None,
    reference: dt.datetime | None = None,
) -> StreamingQuery:
    """Hotspot files: gridded, tagged with a region and appended once per key, each batch logged.

    With ``delay_days`` rows older than that before ``reference`` go to the late table
    instead; one given time makes the same rows late however the files fall into batches.
    """
    if delay_days is not None and reference is None:
        raise ValueError("delay_days needs a reference time")
    typed = readers.typed_hotspots(hotspots)
    lat, lon = F.col("latitude"), F.col("longitude")
    gridded = typed.withColumns({
        "grid_latitude": grid.snap_floor_center(lat), "grid_longitude": grid.snap_floor_center(lon),
        "region_name": grid.region_nearest_haversine(lat, lon),
    })

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = sinks.RunLog(spark, log_path, f"hotspots-{batch_id}")
        run.start(["stream"])
        fresh = batch
        if delay_days is not None:
            late = F.coalesce(F.col("acq_datetime") < F.lit(reference - dt.timedelta(days=delay_days)).cast(time.NTZ), F.lit(False))
            sinks.append_new_by_key(batch.where(late), late_table, HOTSPOT_KEY, partition="acq_date")
            fresh = batch.where(~late)
        run.finish(["stream"], sinks.append_new_by_key(fresh, table, HOTSPOT_KEY, partition="acq_date"))

    return _run(gridded, checkpoint, each)


def env_12h_stream(
    rows: DataFrame, keys: list[str], ts: str, values: list[str], table: str, checkpoint: str, delay: dt.timedelta = dt.timedelta(hours=1),
    latest: dt.datetime | None = None,
) -> StreamingQuery:
    """Half-day means, written when complete and written again when late rows come.

    State is one row of sums and counts per key and half day, in partitions by day. A batch is merged into the
    days it touches and reads no others; each day remembers the last batch merged into it, so a replay changes
    nothing. A half day is complete once a row ``delay`` past its end has been seen; the last time seen is one stored row. The
    days a batch touches, and those that complete by it, are written from their state, so no row is lost however
    late it is. Rows after ``latest`` are summed but do not move that clock. ``table`` is partitioned by ``day``.
    """
    base = table.rstrip("/")
    state_path, clock_path = f"{base}-state", f"{base}-clock"
    span = F.window(F.col(ts).cast("timestamp"), "12 hours")
    group = [*keys, "interval_start", "interval_end", "day"]

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = F.col(ts) if latest is None else F.when(F.col(ts) <= F.lit(latest).cast(time.NTZ), F.col(ts))
        part = batch.groupBy(*keys, span.alias("_w")).agg(
            F.max(known).alias("last"), *[F.sum(v).alias(f"sum_{v}") for v in values], *[F.count(v).alias(f"n_{v}") for v in values]
        ).select(
            "*", F.col("_w.start").cast(time.NTZ).alias("interval_start"), F.col("_w.end").cast(time.NTZ).alias("interval_end")
        ).drop("_w").withColumns({"day": F.to_date("interval_start"), "batch": F.lit(batch_id).cast("bigint")})
        part = durable(part)
        newest = part.agg(F.max("last")).first()[0]
        clock = sinks.read_table(spark, clock_path, "batch BIGINT, newest TIMESTAMP_NTZ, before TIMESTAMP_NTZ").first()
        before = None if clock is None else clock.before if clock.batch == batch_id else clock.newest
        newest = max((t for t in (newest, before) if t), default=None)
        touched = sinks.present_values(part, "day")
        schema = part.drop("last").schema
        old = sinks.read_table(spark, state_path, schema).where(touched)
        merged = old.groupBy("day").agg(F.max("batch").alias("_upto")).where(F.col("_upto") >= batch_id)
        fresh = part.drop("last").join(merged, "day", "left_anti")
        sums = old.unionByName(fresh).groupBy(*group).agg(
            *[F.sum(c).alias(c) for v in values for c in (f"sum_{v}", f"n_{v}")], F.lit(batch_id).cast("bigint").alias("batch")
        )
        sinks.replace_partitions(durable(sums.select(*schema.names)), state_path, "day")
        sinks.replace_table(spark.createDataFrame([(batch_id, newest, before)], "batch BIGINT, newest TIMESTAMP_NTZ, before TIMESTAMP_NTZ").coalesce(1), clock_path)
        if newest is None:
            return
        due = touched
        if before is not None:
            due = due | F.col("day").between((before - delay - dt.timedelta(hours=12)).date(), newest.date())
        whole = sinks.read_table(spark, state_path, schema).where(due & (F.col("interval_end") <= F.lit(newest - delay).cast(time.NTZ)))
        means = [F.try_divide(F.col(f"sum_{v}"), F.col(f"n_{v}")).alias(v) for v in values]
        sinks.replace_partitions(whole.select(*keys, "interval_start", "interval_end", *means, "day"), table, "day")

    return _run(rows, checkpoint, each)


def refresh_on_change(
    events: DataFrame, recompute: Callable[[SparkSession], DataFrame], table: str, checkpoint: str, partition: str | None = None, of_event: Column | None = None
) -> StreamingQuery:
    """New events renew the extract produced by ``recompute``.

    With ``partition``, a column of the extract, only the partitions named by ``of_event``
    of the new events are made again; the filter reaches the inputs of ``recompute``.
    """
    def each(batch: DataFrame, _: int) -> None:
        if partition is None:
            if batch.limit(1).count():
                sinks.replace_table(recompute(batch.sparkSession), table)
            return
        touched = sinks.present_values(batch.select(of_event.alias(partition)), partition)
        sinks.replace_partitions(recompute(batch.sparkSession).where(touched), table, partition)

    return _run(events, checkpoint, each)


def risk_snapshot_stream(payloads: DataFrame, payload: str, order: list[str], table: str, checkpoint: str) -> StreamingQuery:
    """Keep only the newest valid risk collection seen so far; a batch without a newer one leaves it as it is."""
    def each(batch: DataFrame, _: int) -> None:
        snapshot = durable(sinks.latest_snapshot(batch, payload, order, keep_order=True))
        new = snapshot.select("payload_order").first()
        stored = sinks.read_table(batch.sparkSession, table, snapshot.schema).select("payload_order").first()
        if new and (stored is None or tuple(new[0]) >= tuple(stored[0])):
            sinks.replace_table(snapshot, table)

    return _run(payloads, checkpoint, each)


def weather_current_stream(payloads: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Current weather per location with the hour key, in partitions by day; impossible readings are dropped."""
    values = ["temperature_2m", "relative_humidity_2m", "wind_speed_10m"]
    rows = readers.unpivot_hourly_payload(payloads, values)
    keyed = rows.select(
        F.concat_ws("_", F.col("latitude").cast("string"), F.col("longitude").cast("string")).alias("location_id"),
        time.hour_id(F.col("time")).alias("time_id"), F.floor(time.hour_id(F.col("time")) / 100).cast("int").alias("day"), "latitude", "longitude",
        F.col("temperature_2m").alias("temperature_c"), F.col("wind_speed_10m").alias("wind_speed_kmh"),
        F.col("relative_humidity_2m").alias("relative_humidity"),
    )
    valid = cleaning.validate_weather(keyed)

    def each(batch: DataFrame, _: int) -> None:
        sinks.append_new_by_key(batch, table, ["location_id", "time_id", "day"], partition="day")

    return _run(valid, checkpoint, each)

