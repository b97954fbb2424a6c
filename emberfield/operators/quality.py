"""Quality gates: each returns a metrics row (or offending rows); strict helpers raise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberfield.session import dealt, durable


class QualityError(ValueError):
    """A strict gate failed."""


def require_no_rows(offending: DataFrame, message: str) -> None:
    """Raise if any row exists; at most one row reaches the driver."""
    if offending.limit(1).count():
        raise QualityError(message)


def _nulls(df: DataFrame) -> Column:
    total = F.lit(0).cast("bigint")
    for c in df.columns:
        total = total + F.count_if(F.col(c).isNull())
    return total


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def table_check(df: DataFrame, location: str = "location_id") -> DataFrame:
    """No nulls, location set on every row, first column unique."""
    key = df.columns[0]
    base = df.agg(_nulls(df).alias("null_values"), F.count_if(F.col(location).isNull()).alias("null_locations"))
    repeated = duplicate_keys(df.select(key), [key]).agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("c")).scalar()
    return base.select(
        "null_values", (F.col("null_values") == 0).alias("no_nulls"),
        (F.col("null_locations") == 0).alias("location_set"), (repeated == 0).alias("pk_unique"),
    )


def _duplicate_rows(df: DataFrame) -> Column:
    """Rows beyond the first copy of each distinct row."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint")).scalar()


def fire_report(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Row, null and duplicate counts, and whether coordinates are on the globe."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), _nulls(df).alias("null_values"),
        F.coalesce(F.bool_and(F.col(lat).between(-90, 90)), F.lit(True)).alias("lat_valid"),
        F.coalesce(F.bool_and(F.col(lon).between(-180, 180)), F.lit(True)).alias("lon_valid"),
    ).withColumn("duplicate_rows", _duplicate_rows(df))


def weather_report(df: DataFrame, humidity: str, wind: str, temp: str) -> DataFrame:
    """Null and duplicate counts and the number of physically impossible readings."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), _nulls(df).alias("null_values"),
        F.count_if(~F.col(humidity).between(0, 100)).alias("bad_humidity"),
        F.count_if(F.col(wind) < 0).alias("bad_wind"),
        F.count_if(~F.col(temp).between(-50, 60)).alias("bad_temperature"),
    ).withColumn("duplicate_rows", _duplicate_rows(df))


def required_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """Rows missing any required field, each counted once; empty text is missing."""
    missing = F.lit(False)
    for f in fields:
        missing = missing | F.col(f).isNull() | (F.col(f) == "")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(missing).alias("missing_required"))


def target_schema(target: DataFrame, registry: DataFrame, min_id: int, max_id: int) -> None:
    """The target has a text id, the registry its columns and at least one approved row."""
    types = dict(target.dtypes)
    if "id" not in types:
        raise QualityError("target table has no column 'id'")
    if types["id"] != "string":
        raise QualityError(f"target column 'id' must be text, found {types['id']}")
    missing = {"location_id", "grid_latitude", "grid_longitude"} - set(registry.columns)
    if missing:
        raise QualityError("registry is missing required column(s): " + ", ".join(sorted(missing)))
    if not registry.where(F.col("location_id").between(min_id, max_id)).limit(1).count():
        raise QualityError(f"no approved registry rows between {min_id} and {max_id}")


def unique_keys(df: DataFrame, keys: list[str], strict: bool = False) -> DataFrame:
    repeated = duplicate_keys(df, keys)
    if strict:
        require_no_rows(repeated, f"duplicate keys on {keys}")
    return repeated.agg(
        F.count(F.lit(1)).alias("duplicate_keys"), F.coalesce(F.sum("copies"), F.lit(0)).alias("duplicate_rows")
    )


def coverage_diff(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys found on one side only, and whether both sets are equal."""
    def tagged(df: DataFrame, side: str) -> DataFrame:
        return df.select(*keys).withColumn("_side", F.lit(side))

    both = dealt(tagged(left, "l").unionByName(tagged(right, "r")), *keys).groupBy(*keys).agg(
        F.count_if(F.col("_side") == "l").alias("_l"), F.count_if(F.col("_side") == "r").alias("_r")
    )
    only_l, only_r = F.count_if(F.col("_r") == 0), F.count_if(F.col("_l") == 0)
    return both.agg(
        only_l.alias("left_only"), only_r.alias("right_only"), ((only_l == 0) & (only_r == 0)).alias("equal")
    )


def coverage_equal(left: DataFrame, right: DataFrame, keys: list[str]) -> None:
    row = coverage_diff(left, right, keys).first()
    if not row["equal"]:
        raise QualityError(f"coverage differs: {row['left_only']} left only, {row['right_only']} right only")


def shared_metadata_equal(left: DataFrame, right: DataFrame, keys: list[str], shared: list[str]) -> DataFrame:
    """Per shared column, the number of matched rows whose values differ (NULL equals NULL)."""
    joined = left.alias("l").join(right.alias("r"), keys)
    return joined.agg(*[
        F.count_if(~F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))).alias(f"{c}_differs") for c in shared
    ])


def label_domain(df: DataFrame, label: str, allowed: list) -> DataFrame:
    """Label values outside the allowed set with their counts."""
    bad = F.col(label).isNull() | ~F.col(label).isin(allowed)
    return df.where(bad).groupBy(label).agg(F.count(F.lit(1)).alias("rows"))


def forecast_request(df: DataFrame, n_features: int | None = None) -> DataFrame:
    """Checks of a request table: one row per feature with ``observations``.

    Columns used: id, observations, timestamps, grid_row, grid_col.
    """
    obs = F.col("observations")
    steps = F.size(obs)
    widths = F.transform(obs, lambda o: F.size(o))
    first_len, width = F.min(steps), F.min(F.array_min(widths))
    cells = df.where(F.col("grid_row").isNotNull()).groupBy("grid_row", "grid_col").count().where("count > 1")
    repeated = cells.agg(F.count(F.lit(1))).scalar()
    out = df.agg(
        F.count(F.lit(1)).alias("features"),
        F.count_if(steps <= 0).alias("empty_series"),
        (F.max(steps) == first_len).alias("equal_lengths"),
        (F.max(F.array_max(widths)) == width).alias("equal_widths"),
        width.alias("n_features"),
        F.count_if(F.col("timestamps").isNotNull() & (F.size("timestamps") != steps)).alias("bad_timestamps"),
        F.count_if(F.col("grid_row").isNull() != F.col("grid_col").isNull()).alias("half_positions"),
        F.count_if((F.col("grid_row") < 0) | (F.col("grid_col") < 0)).alias("negative_positions"),
    ).withColumn("duplicate_cells", repeated)
    want = F.lit(True) if n_features is None else F.col("n_features") == n_features
    return out.withColumn("valid", (
        (F.col("features") > 0) & (F.col("empty_series") == 0) & F.col("equal_lengths") & F.col("equal_widths")
        & (F.col("bad_timestamps") == 0) & (F.col("half_positions") == 0) & (F.col("negative_positions") == 0)
        & (F.col("duplicate_cells") == 0) & want
    ))


def forecast_response(df: DataFrame, vectors: list[str]) -> DataFrame:
    """Rows whose per-step vectors (those present) differ in length."""
    sizes = F.filter(
        F.array(*[F.when(F.col(v).isNotNull(), F.size(v)) for v in vectors]), lambda n: n.isNotNull()
    )
    uneven = F.array_min(sizes) != F.array_max(sizes)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(uneven).alias("uneven_rows"))


def map_contract(df: DataFrame, rings: str = "rings", factor: str = "risk_factor", probability: str | None = None) -> DataFrame:
    """Violations of the map contract: ring shape, coordinate range, factor 1..5, probability 0..1."""
    r = F.col(rings)
    short = F.exists(r, lambda ring: F.size(ring) < 4)
    is_open = F.exists(r, lambda ring: F.get(ring, F.lit(0)) != F.get(ring, F.size(ring) - 1))
    off = F.exists(F.flatten(r), lambda p: ~(p["x"].between(-180, 180) & p["y"].between(-90, 90)))
    p = F.col(probability) if probability else F.lit(0.0)
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(short).alias("short_rings"), F.count_if(is_open).alias("open_rings"),
        F.count_if(off).alias("bad_coordinates"), F.count_if(~F.col(factor).between(1, 5)).alias("bad_factor"),
        F.count_if(~p.between(0, 1)).alias("bad_probability"),
    )


def narrative_output(posts: DataFrame, members: DataFrame) -> DataFrame:
    """Assignments to unknown posts, posts in several narratives, posts in none."""
    unknown = members.join(posts, "post_id", "left_anti").agg(F.count(F.lit(1)).alias("unknown_posts"))
    several = members.distinct().groupBy("post_id").agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1)).scalar()
    nowhere = posts.join(members, "post_id", "left_anti").agg(F.count(F.lit(1))).scalar()
    return unknown.select("unknown_posts", several.alias("duplicate_posts"), nowhere.alias("unassigned_posts"))


def grid_ids_multi_geometry(df: DataFrame, grid_id: str, geometry_id: str) -> DataFrame:
    """Grid ids that stand for more than one geometry."""
    return df.groupBy(grid_id).agg(F.countDistinct(geometry_id).alias("geometries")).where(F.col("geometries") > 1)


def grid_alignment_summary(left: DataFrame, right: DataFrame, geometry_id: str, grid_id: str, ts: str) -> DataFrame:
    """Named checks of two exports of the same grid, one row each.

    Both exports are read once: each row counts for its geometry, its time, both together,
    and its grid id, and every check is a count over these keys.
    """
    side = lambda df, n: df.select(F.lit(n).alias("_side"), F.col(geometry_id).alias("_g"), F.col(grid_id).alias("_i"), F.col(ts).alias("_t"))
    rows = side(left, "left").unionByName(side(right, "right"))
    here = [F.max(F.col("_side") == n).alias(n) for n in ("left", "right")]
    # a row per geometry and time, and one per side, grid id and geometry; all checks are counts over these
    whole = F.struct(F.lit(None).cast("string").alias("side"), F.lit(None).cast(rows.schema["_i"].dataType).alias("i"), F.col("_g").alias("g"), F.col("_t").alias("t"), F.lit(True).alias("timed"))
    placed = F.struct(F.col("_side").alias("side"), F.col("_i").alias("i"), F.col("_g").alias("g"), F.lit(None).cast(rows.schema["_t"].dataType).alias("t"), F.lit(False).alias("timed"))
    keyed = rows.select("_side", F.explode(F.array(whole, placed)).alias("k")).select("_side", "k.*")
    seen = durable(keyed.groupBy("timed", "side", "i", "g", "t").agg(*here))
    timed = seen.where("timed")
    both = lambda *keys: timed.groupBy(*keys).agg(F.max("left").alias("left"), F.max("right").alias("right"))
    equal = (F.count_if(~F.col("left") | ~F.col("right")) == 0).alias("passed")
    sets = [both("g").select(F.lit("same_geometries").alias("check"), "left", "right"), both("t").select(F.lit("same_times").alias("check"), "left", "right"),
            timed.select(F.lit("same_geometry_times").alias("check"), "left", "right")]
    done = sets[0].unionByName(sets[1]).unionByName(sets[2]).groupBy("check").agg(equal)
    many = seen.where(~F.col("timed")).groupBy("side", "i").agg((F.count(F.lit(1)) > 1).alias("_many"))
    unique = many.groupBy("side").agg((F.count_if("_many") == 0).alias("passed"))
    named = F.explode(F.array(*[F.concat(F.lit(n), F.lit("_grid_id_unique")) for n in ("left", "right")])).alias("check")
    any_row = seen.limit(1).select(named)
    found = unique.select(F.concat("side", F.lit("_grid_id_unique")).alias("check"), "passed")
    return done.unionByName(any_row.join(F.broadcast(found), "check", "left").select("check", F.coalesce("passed", F.lit(True)).alias("passed")))


def temporal_structure(df: DataFrame, ts: str, expected_per_year: int, hours: list[int]) -> DataFrame:
    """Per year: distinct times, their range, and whether count and hours are as expected."""
    times = df.select(ts).distinct()
    return times.groupBy(F.year(ts).alias("year")).agg(
        F.count(F.lit(1)).alias("timestamps"), F.min(ts).alias("first"), F.max(ts).alias("last"),
        (F.count(F.lit(1)) == expected_per_year).alias("complete"),
        F.bool_and(F.hour(ts).isin(hours)).alias("hours_ok"),
    )


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, nulls, distinct values."""
    stats = df.agg(*[
        F.struct(
            F.lit(c).alias("column"), F.lit(t).alias("type"), F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col(c).isNull()).alias("nulls"),
        ).alias(c)
        for c, t in df.dtypes
    ]).select(F.explode(F.array(*df.columns)).alias("s")).select("s.*")
    values = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in df.columns
    ])).alias("kv")).select("kv.*").where(F.col("v").isNotNull())
    distinct = values.distinct().groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))
    return stats.join(distinct, "column", "left").withColumn(
        "distinct_values", F.coalesce("distinct_values", F.lit(0).cast("bigint"))
    )


def synthetic_post_schema(
    df: DataFrame, platforms: list[str], themes: str = "theme", split: str = "split",
    shares: dict[str, float] | None = None,
) -> DataFrame:
    """Checks of a generated post table, each as a count or flag.

    Columns used: id, platform, text, credibility, created (ISO text), theme, split.
    """
    shares = shares or {"train": 0.70, "validation": 0.15, "test": 0.15}
    created = F.col("created").try_cast("timestamp_ntz")
    repeated = duplicate_keys(df.select("id"), ["id"]).agg(F.count(F.lit(1))).scalar()
    train = df.where(F.col(split) == "train").groupBy(themes).agg(F.count(F.lit(1)).alias("n"))
    total = train.agg(F.sum("n")).scalar()
    rare = train.withColumn("_t", total).agg(F.count_if(F.col("n") < F.col("_t") * 0.05)).scalar()
    out = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("id").isNull() | F.col("text").isNull() | F.col("platform").isNull()).alias("missing_required"),
        F.count_if(~F.col("platform").isin(platforms)).alias("bad_platform"),
        F.count_if(~F.length("text").between(20, 300)).alias("bad_length"),
        F.count_if(~F.col("credibility").between(0, 1)).alias("bad_credibility"),
        F.count_if(created.isNull()).alias("bad_time"),
        F.count_if(~F.year(created).between(2019, 2023)).alias("unusual_year"),
        *[
            (F.abs(F.count_if(F.col(split) == s) / F.count(F.lit(1)) - v) <= 0.05).alias(f"{s}_share_ok")
            for s, v in shares.items()
        ],
    )
    return out.withColumns({"duplicate_ids": repeated, "rare_themes": rare})


def sequence_shape_contract(df: DataFrame, sequence: str, steps: int, features: int | None) -> DataFrame:
    """Rows whose sequence is not ``steps`` long or has a row of another width."""
    s = F.col(sequence)
    width_ok = F.lit(True) if features is None else F.forall(s, lambda o: F.size(o) == features)
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if((F.size(s) != steps) | ~width_ok).alias("bad_shape")
    )
