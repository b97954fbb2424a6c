"""Gridded environment data: half-day means, cell means, one-to-one merges, small summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberfield.functions import fire, time
from emberfield.operators.ordering import exact_quantiles, previous_row
from emberfield.operators.quality import QualityError
from emberfield.session import durable


def env_12h_mean(
    df: DataFrame, keys: list[str], ts: str, values: list[str], start: Column, end: Column, hours: int = 12
) -> DataFrame:
    """Mean per ``hours`` interval counted from ``start``; only intervals wholly before ``end``."""
    width = F.lit(hours * 3600)
    i = F.floor(time.seconds_between(start, F.col(ts)) / width)
    numbered = df.where((F.col(ts) >= start) & (F.col(ts) < end)).withColumn("_i", i)
    means = numbered.groupBy(*keys, "_i").agg(*[F.avg(v).alias(v) for v in values])
    begin = start + F.make_dt_interval(F.lit(0), (F.col("_i") * hours).cast("int"))
    finish = start + F.make_dt_interval(F.lit(0), ((F.col("_i") + 1) * hours).cast("int"))
    out = means.withColumns({"interval_start": begin, "interval_end": finish})
    return out.where(F.col("interval_end") <= end).drop("_i")


def cell_region_mean(df: DataFrame, cell: list[str], ts: str, values: list[str]) -> DataFrame:
    return df.groupBy(*cell, ts).agg(*[F.avg(v).alias(v) for v in values])


def monthly_mean(df: DataFrame, ts: str, value: str) -> DataFrame:
    return df.groupBy(time.floor_month(F.col(ts)).alias("month")).agg(F.avg(value).alias(f"mean_{value}"))


def monthly_count(df: DataFrame, ts: str) -> DataFrame:
    return df.groupBy(time.floor_month(F.col(ts)).alias("month")).agg(F.count(F.lit(1)).alias("incidents"))


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last bin is closed; empty bins count 0."""
    limits = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    lo, hi = limits.getField("lo"), limits.getField("hi")
    v = F.col(value)
    width = (hi - lo) / bins
    index = F.when(hi == lo, F.lit(bins // 2)).otherwise(F.least(F.floor((v - lo) / width), F.lit(bins - 1)))
    counted = df.where(v.isNotNull()).groupBy(index.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.agg(F.count(F.lit(1))).select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every.join(counted, "bin", "left").select("bin", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def describe(df: DataFrame, value: str) -> DataFrame:
    """count, mean, sample std, min, exact quartiles and max of one column, one row per statistic."""
    base = df.agg(F.map_from_arrays(
        F.array(*[F.lit(s) for s in ("count", "mean", "std", "min", "max")]),
        F.array(
            F.count(value).cast("double"), F.avg(value), F.stddev(value),
            F.min(value).cast("double"), F.max(value).cast("double"),
        ),
    ).alias("m")).select(F.explode("m").alias("statistic", "value"))
    q = exact_quantiles(df, value, [0.25, 0.5, 0.75]).select(
        F.concat((F.col("probability") * 100).cast("int").cast("string"), F.lit("%")).alias("statistic"),
        F.col("quantile").alias("value"),
    )
    return base.unionByName(q)


def soil_moisture_by_time(df: DataFrame, ts: str, surface: str, rootzone: str) -> DataFrame:
    return df.groupBy(ts).agg(
        F.avg(surface).alias("surface_mean"), F.avg(rootzone).alias("rootzone_mean"),
        F.min(surface).alias("surface_min"), F.max(surface).alias("surface_max"),
        F.min(rootzone).alias("rootzone_min"), F.max(rootzone).alias("rootzone_max"),
    )


def group_mean(df: DataFrame, key: str, values: list[str]) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.avg(v).alias(v) for v in values])


def merge_one_to_one(
    left: DataFrame, right: DataFrame, keys: list[str], shared: list[str],
    prefixes: tuple[str, str] = ("era5_", "era5land_"), check: bool = True,
) -> DataFrame:
    """One-to-one merge: keys unique and equal on both sides, shared metadata equal.

    Other columns get the prefix of their side; the shared ones are kept once. Both sides
    meet once per key; the stored result tells every violation in one row, and a
    ``QualityError`` names them. Without ``check`` keys of one side only are left out.
    """
    def packed(df: DataFrame, prefix: str) -> Column:
        own = [c for c in df.columns if c not in keys and c not in shared]
        return F.struct(F.lit(True).alias("_here"), *shared, *[F.col(c).alias(prefix + c) for c in own])

    sides = [df.select(*keys, packed(df, prefix).alias("_s")) for df, prefix in zip((left, right), prefixes, strict=True)]
    kinds = [df.schema["_s"].dataType for df in sides]
    both = sides[0].select(*keys, F.col("_s").alias("_l"), F.lit(None).cast(kinds[1]).alias("_r")).unionByName(
        sides[1].select(*keys, F.lit(None).cast(kinds[0]).alias("_l"), F.col("_s").alias("_r"))
    )
    per_key = both.groupBy(*keys).agg(
        F.count("_l").alias("_nl"), F.count("_r").alias("_nr"), F.first("_l", ignorenulls=True).alias("_l"), F.first("_r", ignorenulls=True).alias("_r")
    )
    if check:
        per_key = durable(per_key)
        matched = (F.col("_nl") > 0) & (F.col("_nr") > 0)
        found = per_key.agg(
            F.count_if(F.col("_nl") > 1).alias("keys repeated on the left"), F.count_if(F.col("_nr") > 1).alias("keys repeated on the right"),
            F.count_if(F.col("_nr") == 0).alias("keys on the left only"), F.count_if(F.col("_nl") == 0).alias("keys on the right only"),
            *[F.count_if(matched & ~F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}"))).alias(f"{c} differs") for c in shared],
        ).first().asDict()
        wrong = [f"{what}: {n}" for what, n in found.items() if n]
        if wrong:
            raise QualityError("no one-to-one merge, " + "; ".join(wrong))
    own = lambda df, p, side: [F.col(f"{side}.{p}{c}").alias(p + c) for c in df.columns if c not in keys and c not in shared]
    return per_key.where((F.col("_nl") > 0) & (F.col("_nr") > 0)).select(
        *keys, *[F.col(f"_l.{c}").alias(c) for c in shared], *own(left, prefixes[0], "_l"), *own(right, prefixes[1], "_r")
    )


def enso_table(df: DataFrame, order: list[str]) -> DataFrame:
    """Climate index rows with month, phase and the value six rows earlier in file order.

    ``order`` is the file order: the lag is taken before the chronological sort.
    """
    month = time.enso_month(F.col("SEAS"))
    typed = df.select(*order, *[c for c in ("YR", "SEAS", "ANOM") if c not in order]).withColumns({
        "_m": month, "oni_anomaly": F.col("ANOM").try_cast("double"),
    })
    lagged = previous_row(typed, order, {"oni_lag6m": "oni_anomaly"}, step=6)
    start = F.make_timestamp_ntz(F.col("YR").cast("int"), F.col("_m"), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return lagged.select(
        F.concat_ws("-", F.col("YR").cast("string"), F.lpad(F.col("_m").cast("string"), 2, "0")).alias("record_year_month"),
        start.alias("datetime_record"), time.month_id(F.col("YR"), F.col("_m")).alias("time_id"),
        "oni_anomaly", time.enso_phase(F.col("oni_anomaly")).alias("enso_phase"), "oni_lag6m",
    )


def weather_strip(df: DataFrame, ts: str, now: Column, n: int = 6) -> DataFrame:
    """The hourly rows of today from the current hour on, at most ``n`` hours ahead."""
    hour, current = F.hour(ts), F.hour(now)
    kept = df.where((F.to_date(ts) == F.to_date(now)) & hour.between(current, current + (n - 1)))
    half_up = F.floor(F.col("temperature") + 0.5).cast("bigint")
    wind = F.floor(F.col("wind_speed") + 0.5).cast("bigint")
    return kept.select(
        F.when(hour == current, "NOW").otherwise(F.date_format(ts, "HH:mm")).alias("time"),
        F.concat(half_up.cast("string"), F.lit("°C")).alias("temp"),
        F.concat_ws(" ", fire.compass8(F.col("wind_direction")), wind.cast("string")).alias("wind"),
        (hour == current).alias("now"), (F.col("temperature") < 38).alias("amber"), F.col(ts).alias("ts"),
    )
