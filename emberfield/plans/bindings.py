"""Views that present the benchmark tables as fire, weather, facility and post data.

Only deterministic arithmetic, so the SQL views in ``sqlviews`` give the same rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberfield.functions import fire, grid, text, time
from emberfield.session import dealt


def lat_of(a: Column, b: Column) -> Column:
    return F.lit(-39.6) + ((a * 7919 + b * 13) % 6000) / F.lit(1000.0)


def lon_of(a: Column, b: Column) -> Column:
    return F.lit(140.5) + ((a * 104729 + b * 37) % 10000) / F.lit(1000.0)


class Tables:
    """Lazy access to the tables of one scale-factor folder and the views on them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def hot(self) -> DataFrame:
        """Hotspot detections from events."""
        k = F.regexp_extract("props", r"(\d+)", 1).cast("bigint")
        ev = self.table("events").select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"))
        u, kk = F.col("user_id"), F.col("k")
        return ev.select(
            "event_id", "ts", "user_id", "k", F.col("event_type").alias("satellite"), F.col("value").alias("frp"),
            lat_of(u, kk).alias("lat"), lon_of(u, kk).alias("lon"),
            F.when(F.hour("ts") < 12, "D").otherwise("N").alias("daynight"),
            (u % 10).alias("cell_x"), (kk % 10).alias("cell_y"), F.to_date("ts").alias("acq_date"),
            F.date_format("ts", "HHmm").alias("acq_time"),
            (F.lit(300.0) + (kk % 50)).alias("brightness"),
            F.when(F.col("event_id") % 13 != 0, F.lit(280.0) + (u % 20)).alias("bright_t31"),
            F.when(kk % 3 == 0, "l").when(kk % 3 == 1, "n").otherwise("h").alias("band"),
        )

    @cached_property
    def fires(self) -> DataFrame:
        """Fires from orders: ignition, burnt area and a diamond-shaped extent."""
        key, c = F.col("o_orderkey"), F.col("o_custkey")
        area = F.col("o_totalprice") / F.pow(F.lit(10.0), (F.lit(2) + key % 4).cast("double"))
        o = self.table("orders").select(
            key.alias("fire_id"), F.col("o_orderdate").alias("ignition_date"), area.alias("area_ha"),
            F.when(F.col("o_orderstatus") == "F", "Bushfire").when(F.col("o_orderstatus") == "P", "Planned Burn")
            .otherwise("Unknown").alias("fire_type"),
            lat_of(key, c % 100).alias("lat"), lon_of(key, c % 100).alias("lon"),
            (F.lit(0.01037) + (key % 4) * F.lit(0.01)).alias("half"),
        )
        return o.withColumns({
            "season": time.season(F.col("ignition_date")), "size_class": fire.size_class(F.col("area_ha")),
        })

    @cached_property
    def fire_shapes(self) -> DataFrame:
        """Fires with their extent as rings."""
        return self.fires.withColumn("rings", diamond(F.col("lon"), F.col("lat"), F.col("half")))

    @cached_property
    def fire_det(self) -> DataFrame:
        """Satellite detections matched to fires, from lineitem and orders."""
        li = self.table("lineitem").select(
            F.col("l_orderkey").alias("fire_id"), "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice"
        )
        o = self.table("orders").select(F.col("o_orderkey").alias("fire_id"), F.col("o_orderdate").alias("ignition_date"))
        days = (F.col("l_partkey") * 7 + F.col("l_linenumber") * 3) % 14 - 2 + F.when(F.col("l_partkey") % 50 == 0, 200).otherwise(0)
        return li.join(o, "fire_id").select(
            "fire_id", "ignition_date", time.plus_days(F.col("ignition_date"), days.cast("int")).alias("datetime"),
            F.col("l_quantity").alias("frp_peak"), (F.col("l_extendedprice") / F.lit(1000.0)).alias("frp_cumulative"),
        )

    @cached_property
    def obs(self) -> DataFrame:
        """Environment series, one row per cell and time, from lineitem."""
        lines = dealt(self.table("lineitem").withColumnsRenamed({"l_suppkey": "cell", "l_shipdate": "ts"}), "cell", "ts")
        return lines.groupBy("cell", "ts").agg(
            F.max("l_quantity").alias("quantity"), F.max("l_extendedprice").alias("price"),
            F.max("l_discount").alias("discount"), F.max("l_tax").alias("tax"),
            F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("is_burning"),
        )

    @cached_property
    def registry(self) -> DataFrame:
        """Location registry from customer keys."""
        k = F.col("c_custkey")
        return self.table("customer").select(
            (k + 1).alias("location_id"), lat_of(k, k % 100).alias("grid_latitude"), lon_of(k, k % 100).alias("grid_longitude"),
            F.col("c_mktsegment").alias("region_name"), (k % 50).alias("grid_row"), F.floor(k / 50).cast("bigint").alias("grid_col"),
        )

    @cached_property
    def facility(self) -> DataFrame:
        """Facilities from customers; every 17th lacks coordinates."""
        k = F.col("c_custkey")
        has = k % 17 != 0
        return self.table("customer").select(
            k.alias("_id"), F.col("c_name").alias("facility_name"), F.col("c_mktsegment").alias("lga"),
            F.concat(F.lit("Road "), (k % 40).cast("string")).alias("facility_address"),
            F.concat(F.lit("Town "), F.col("c_nationkey").cast("string")).alias("suburb"),
            F.when(has, lat_of(k * 3 + 1, k % 77)).alias("latitude"), F.when(has, lon_of(k * 3 + 1, k % 77)).alias("longitude"),
        )

    @cached_property
    def pred(self) -> DataFrame:
        """Predictions from events: label = error, probability = k / 99."""
        return self.hot.select(
            "event_id", F.when(F.col("satellite") == "error", 1).otherwise(0).alias("y"), (F.col("k") / F.lit(99.0)).alias("p"),
            "cell_x", "cell_y", "satellite", "daynight", "k",
        )

    @cached_property
    def posts(self) -> DataFrame:
        """Posts from documents."""
        d, n = F.col("doc_id"), F.col("n_chars")
        score = (n % 11) / F.lit(10.0)
        return self.table("documents").select(
            d.alias("post_id"), score.alias("score"), n.alias("share_count"),
            F.get(F.array(*[F.lit(p) for p in text.PLATFORMS]), (d % 4).cast("int")).alias("platform"),
            (F.lit("2024-01-01").cast(time.NTZ) + F.make_dt_interval(F.lit(0), F.lit(0), d.cast("int"))).alias("ts"),
            text.severity_db(score).alias("severity"), F.col("source").alias("author_name"), F.col("text").alias("content"),
        )

    @cached_property
    def members(self) -> DataFrame:
        """Narrative membership from conversations."""
        docs = self.table("documents").agg(F.count(F.lit(1))).scalar()
        return self.table("conversations").select(
            F.col("conv_id").alias("cluster_id"), ((F.col("conv_id") * 8 + F.col("turn")) % docs).alias("post_id")
        ).distinct()

    @cached_property
    def clusters(self) -> DataFrame:
        """Narratives: one per conversation."""
        c = F.col("conv_id")
        return self.table("conversations").select("conv_id").distinct().select(
            c.alias("id"), F.concat(F.lit("Narrative "), c.cast("string")).alias("summary"),
            (c % 25).cast("int").alias("incident_id"),
            F.get(F.array(*[F.lit(x) for x in text.SPREAD_STATES]), (c % 3).cast("int")).alias("spread_status"),
            F.get(F.array(*[F.lit(x) for x in text.REVIEW_STATES]), (c % 4).cast("int")).alias("review_status"),
        )

    @cached_property
    def incidents(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), (F.col("n_nationkey") % 3 != 0).alias("is_active")
        )

    @cached_property
    def hubs(self) -> tuple[DataFrame, DataFrame]:
        """Location and time hubs of the detections."""
        from emberfield.operators import hubs

        src = self.hot.select("event_id", F.col("lat").alias("original_latitude"), F.col("lon").alias("original_longitude"),
                              F.col("ts").alias("datetime_record"))
        return hubs.location_registry([src]), hubs.time_registry([src])


def diamond(x: Column, y: Column, h: Column) -> Column:
    return F.array(F.array(
        grid.point(x - h, y), grid.point(x, y - h), grid.point(x + h, y), grid.point(x, y + h), grid.point(x - h, y)
    ))
