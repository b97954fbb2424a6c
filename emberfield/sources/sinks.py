"""Sinks and load rules on Parquet tables: append by key, upsert, replace, run log, snapshot.

A table is a folder of Parquet files. Rewrites go to a fresh folder first and replace
the target only when complete, so a lost executor or driver never leaves half a table.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType, _parse_datatype_string

from emberfield import schemas
from emberfield.functions import geometry
from emberfield.session import durable


def table_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def delete_table(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _previous(path: str) -> str:
    return f"{path.rstrip('/')}.previous"


def read_table(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The table, or an empty one of the same schema before the first load.

    If a replacement broke off between its two renames, the table is still there under its other name.
    """
    st = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
    for place in (path, _previous(path)):
        if table_exists(spark, place):
            return spark.read.schema(st).parquet(place)
    return spark.createDataFrame([], st)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def geojson_features(df: DataFrame, rings: str) -> DataFrame:
    """One GeoJSON feature text per row, all other columns as properties."""
    props = [c for c in df.columns if c != rings]
    feature = F.struct(
        F.lit("Feature").alias("type"), geometry.geojson_polygon(F.col(rings)).alias("geometry"),
        F.struct(*props).alias("properties"),
    )
    return df.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value"))


def write_geojson(df: DataFrame, rings: str, path: str, csv_path: str | None = None) -> None:
    """Newline-delimited features, and optionally a CSV copy without the geometry."""
    geojson_features(df, rings).write.mode("overwrite").text(path)
    if csv_path:
        write_csv(df.drop(rings), csv_path)


def present_values(batch: DataFrame, column: str, most: int = 1000) -> Column:
    """Filter for the partitions a batch touches: its values, or their range if there are more than ``most``."""
    values = [r[0] for r in batch.select(column).distinct().limit(most + 1).collect()]
    known = [v for v in values if v is not None]
    if len(values) <= most:
        return F.col(column).isin(known) if known else F.lit(False)
    low, high = batch.agg(F.min(column), F.max(column)).first()
    return F.col(column).between(low, high)


def new_by_key(
    batch: DataFrame, target: DataFrame, keys: list[str], order: list[str] | None = None, within: str | None = None
) -> DataFrame:
    """Rows of ``batch`` that an insert ignoring conflicts on ``keys`` would add.

    ``within`` names a key column (e.g. the date) whose values in the batch limit the
    part of the target that is read; on a partitioned table they prune partitions.

    Copies inside the batch collapse to the first by ``order``; a row with a NULL key
    part never conflicts, as in an SQL unique constraint.
    """
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    rest = [c for c in batch.columns if c not in keys]
    # a number of its own keeps every row with a NULL key apart
    apart = batch.withColumn("_apart", F.when(null_key, F.monotonically_increasing_id()))
    if rest:
        first = F.min_by(F.struct(*rest), F.struct(*(order or rest)))
        keyed = apart.groupBy(*keys, "_apart").agg(first.alias("_r")).select(
            *[F.col(c) if c in keys else F.col(f"_r.{c}") for c in batch.columns]
        )
    else:
        keyed = apart.distinct().drop("_apart")
    seen = target.select(*keys)
    if within:
        seen = seen.where(present_values(batch, within))
    return keyed.join(seen, keys, "left_anti").select(*batch.columns)


def stored_and_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` written to the shared folder, and its rows, counted while it was written."""
    seen = Observation()
    stored = durable(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return stored, seen.get["rows"]


def append_new_by_key(
    batch: DataFrame, path: str, keys: list[str], order: list[str] | None = None, partition: str | None = None
) -> dict[str, int]:
    """Idempotent append; returns rows fetched, inserted and skipped.

    With ``partition`` (a key column) the table is partitioned by it and only the
    partitions the batch touches are compared. The batch is computed once, and rows are counted while they are written.
    """
    batch, fetched = stored_and_counted(batch)
    target = read_table(batch.sparkSession, path, batch.schema)
    if partition:
        target = target.where(present_values(batch, partition))
    fresh, inserted = stored_and_counted(new_by_key(batch, target, keys, order))
    writer = fresh.write.mode("append")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
    return {"fetched": fetched, "inserted": inserted, "skipped": fetched - inserted}


def insert_new_incidents(batch: DataFrame, path: str, locate=None) -> dict[str, int]:
    """Append incidents whose id is unknown; ``locate`` adds ``location_id`` to the new ones only.

    Ids alone decide, whatever their dates. They are looked up in the table's ``IdIndex``: a load reads the buckets of its own
    ids, not all that were ever stored.
    """
    from emberfield.sources.idindex import IdIndex

    spark = batch.sparkSession
    schema = batch.schema if "location_id" in batch.columns else StructType([*batch.schema.fields, StructField("location_id", LongType())])
    batch, fetched = stored_and_counted(batch)
    fresh = durable(new_by_key(batch, IdIndex(spark, path).seen(batch), ["id"], ["updated"]))
    located = locate(fresh) if locate else fresh.withColumn("location_id", F.lit(None).cast("bigint"))
    located = durable(located.select(*schema.names))
    inserted, matched = located.agg(F.count(F.lit(1)), F.count("location_id")).first()
    located.write.mode("append").parquet(path)
    return {
        "fetched": fetched, "skipped": fetched - inserted, "inserted": inserted, "matched": matched,
        "unmatched": inserted - matched,
    }


def _key(df: DataFrame, name: str) -> Column:
    """A join key; coordinates are compared as whole millionths."""
    return F.round(F.col(name) * 1_000_000).cast("bigint") if df.schema[name].dataType.typeName() == "double" else F.col(name)


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Target with ``value`` replaced by the batch's last row per key, also by a NULL, and new keys added."""
    parts = [f"_k{i}" for i in range(len(keys))]
    last = batch.select(*[_key(batch, k).alias(p) for k, p in zip(keys, parts, strict=True)], *keys, value, order).groupBy(*parts).agg(
        F.max_by(F.struct(*keys, value), order).alias("_new")
    )
    joined = target.withColumns({p: _key(target, k) for k, p in zip(keys, parts, strict=True)}).join(last, parts, "full_outer")
    new = F.col("_new")
    return joined.select(*[
        F.when(new.isNotNull(), new[value]).otherwise(F.col(c)).alias(c) if c == value
        else F.coalesce(F.col(c), new[c]).alias(c) if c in keys else F.col(c)
        for c in target.columns
    ])


def upsert_location(target: DataFrame, batch: DataFrame, order: str) -> DataFrame:
    return upsert(target, batch, ["grid_latitude", "grid_longitude"], "region_name", order)


def upsert_time(target: DataFrame, batch: DataFrame, order: str) -> DataFrame:
    return upsert(target, batch, ["datetime_record"], "season", order)


def _in_buckets(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64(*[_key(df, k) for k in keys]), F.lit(buckets)).cast("int"))


def _write_buckets(df: DataFrame, path: str) -> None:
    """One folder per bucket; a large bucket is written by several tasks."""
    df.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(path)


def store_in_buckets(df: DataFrame, path: str, keys: list[str], buckets: int = 64) -> None:
    """First load of a table for ``upsert_table``; its number of buckets stays as it is."""
    _write_buckets(_in_buckets(df, keys, buckets), path)


def _switch_buckets(spark: SparkSession, path: str) -> None:
    """Put the complete buckets of a finished merge in the place of the old ones.

    If the driver ends in between, the buckets still to be moved are found and moved before the next merge.
    """
    jvm, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    staged, table = jvm.Path(f"{path}.merging"), jvm.Path(path)
    fs = table.getFileSystem(conf)
    if fs.exists(jvm.Path(staged, "_SUCCESS")):
        fs.mkdirs(table)
        for part in fs.listStatus(staged):
            name = part.getPath().getName()
            if name.startswith("bucket="):
                fs.delete(jvm.Path(table, name), True)
                if not fs.rename(part.getPath(), jvm.Path(table, name)):
                    raise OSError(f"could not put {name} in its place in {path}")
    fs.delete(staged, True)


def read_buckets(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The table of ``store_in_buckets`` with its column ``bucket``; empty before the first load."""
    st = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
    whole = StructType([*st.fields, StructField("bucket", IntegerType())])
    return spark.read.schema(whole).parquet(path) if table_exists(spark, path) else spark.createDataFrame([], whole)


def upsert_table(batch: DataFrame, path: str, schema: str | StructType, keys: list[str], value: str, order: str, buckets: int = 64) -> list[int]:
    """``upsert`` on a stored table: only the hash buckets that hold a key of the batch are read and written; returns them.

    The merged buckets are written beside the table, whole, and take their places one after the other, so a reader may
    see some of them before and some after the batch. Loads must not run at the same time; one that broke off is finished by the next.
    """
    spark, path = batch.sparkSession, path.rstrip("/")
    _switch_buckets(spark, path)
    batch = durable(_in_buckets(batch, keys, buckets))
    touched = sorted(r[0] for r in batch.select("bucket").distinct().collect())
    if touched:
        target = read_buckets(spark, path, schema).where(F.col("bucket").isin(touched)).drop("bucket")
        _write_buckets(_in_buckets(upsert(target, batch, keys, value, order), keys, buckets), f"{path}.merging")
        _switch_buckets(spark, path)
    return touched


def insert_ignore_time(batch: DataFrame, path: str) -> dict[str, int]:
    return append_new_by_key(batch, path, ["datetime_record"])


def replace_table(df: DataFrame, path: str) -> None:
    """Create or replace: a complete copy is written beside the table, then takes its place.

    The old table is moved aside before and deleted after, so at every moment
    ``read_table`` finds one whole table.
    """
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    df.write.parquet(staged)
    jvm = spark.sparkContext._jvm
    old, new, aside = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, staged, _previous(path)))
    fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(old):
        if fs.exists(aside):
            fs.delete(aside, True)
        if not fs.rename(old, aside):
            raise OSError(f"could not move {path} aside")
    if not fs.rename(new, old):
        raise OSError(f"could not put {staged} in place of {path}")
    if fs.exists(aside):
        fs.delete(aside, True)


def replace_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace the partitions that ``df`` holds rows of, and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


# Sort order of each exported table.
EXPORT_ORDER = {
    "detections": ["acq_date", "acq_time"], "cells": ["acq_date", "daynight", "satellite"], "passes": ["pass_datetime"],
    "fires": ["ignition_date", "fire_id"], "daily_detections": ["datetime"],
}


def sort_for_export(df: DataFrame, kind: str) -> DataFrame:
    """Globally sorted rows (range-partitioned by Spark) in the order of the named export."""
    return df.orderBy(*EXPORT_ORDER[kind])


def truncate_and_load(df: DataFrame, path: str) -> None:
    replace_table(df, path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def project_to_target(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fixed column order; columns the source lacks are NULL."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in columns])


class RunLog:
    """Append-only run log; the latest row of a run is its state."""

    def __init__(self, spark: SparkSession, path: str, name: str):
        self.spark, self.path, self.name = spark, path, name
        self.run_id = uuid.uuid4().hex
        self.started = None
        self.attempted: list[str] = []

    def _write(self, **values) -> None:
        row = {f.name: None for f in _parse_datatype_string(schemas.RUN_LOG).fields}
        row.update(run_id=self.run_id, pipeline_name=self.name, started_at=self.started,
                   sources_attempted=",".join(self.attempted), **values)
        self.spark.createDataFrame([row], schemas.RUN_LOG).write.mode("append").parquet(self.path)

    def start(self, attempted: list[str]) -> None:
        self.started, self.attempted = dt.datetime.now(), list(attempted)
        self._write(status="RUNNING")

    def finish(self, succeeded: list[str], counts: dict[str, int], error: str | None = None) -> str:
        status = "FAILED" if error else ("SUCCESS" if succeeded else "PARTIAL")
        self._write(
            status=status, sources_succeeded=",".join(succeeded), finished_at=dt.datetime.now(),
            rows_fetched=counts.get("fetched"), rows_inserted=counts.get("inserted"),
            rows_skipped=counts.get("skipped"), error_message=error,
        )
        return status


def run_states(log: DataFrame) -> DataFrame:
    """Latest state per run (a finished row wins over its start)."""
    rank = F.struct(F.col("finished_at").isNotNull(), "finished_at")
    cols = [c for c in log.columns if c != "run_id"]
    return log.groupBy("run_id").agg(F.max_by(F.struct(*cols), rank).alias("s")).select("run_id", "s.*")


def load_report(inputs: dict[str, DataFrame], outputs: dict[str, DataFrame], hubs: dict[str, DataFrame]) -> DataFrame:
    """Row counts per table in one result: (kind, name, rows)."""
    parts = []
    for kind, tables in (("input", inputs), ("output", outputs), ("registry", hubs)):
        for name, df in tables.items():
            parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(kind).alias("kind"), F.lit(name).alias("name"), "rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def valid_collection(payload: Column) -> Column:
    """The parsed risk collection, NULL unless it is a valid FeatureCollection."""
    parsed = F.from_json(payload, schemas.RISK_COLLECTION)
    ok = (parsed["type"] == "FeatureCollection") & parsed["features"].isNotNull() & F.forall(
        parsed["features"],
        lambda f: (f["type"] == "Feature") & f["geometry"]["coordinates"].isNotNull()
        & f["properties"]["risk_factor"].between(1, 5),
    )
    return F.when(F.coalesce(ok, F.lit(False)), parsed)


def latest_snapshot(payloads: DataFrame, payload: str, order: list[str], keep_order: bool = False) -> DataFrame:
    """Features of the newest valid payload; nothing valid gives an empty collection.

    Only the order keys of valid payloads are compared; the newest one alone is taken apart.
    With ``keep_order`` its order key is returned as ``payload_order``.
    """
    key = F.struct(*order)
    valid = valid_collection(F.col(payload))
    newest = payloads.agg(F.max(F.when(valid.isNotNull(), key)).alias("k")).scalar()
    best = payloads.where(key == newest).withColumn("_c", valid).where(F.col("_c").isNotNull())
    one = best.agg(F.max(payload).alias(payload), F.first(key).alias("k"))
    features = one.select(F.explode(valid_collection(F.col(payload))["features"]).alias("f"), "k")
    kept = [F.col("k").alias("payload_order")] if keep_order else []
    return features.select(F.col("f.geometry").alias("geometry"), F.col("f.properties.risk_factor").alias("risk_factor"), *kept)


def read_snapshot(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The stored snapshot; missing or unreadable is an empty collection."""
    try:
        return read_table(spark, path, schema)
    except AnalysisException:
        return spark.createDataFrame([], schema)
