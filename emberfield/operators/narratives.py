"""Misinformation posts, narrative clusters and incidents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberfield.functions.text import SEVERITY_RANK, severity_rank
from emberfield.operators.ordering import number_rows


def _severity_name(rank: Column) -> Column:
    out = None
    for name, r in SEVERITY_RANK.items():
        out = F.when(rank == r, name) if out is None else out.when(rank == r, name)
    return out


def narrative_cluster_objects(clusters: DataFrame, incidents: DataFrame, members: DataFrame, posts: DataFrame) -> DataFrame:
    """One row per narrative: severity, counts, shares, time range, platforms.

    Posts are aggregated per cluster before anything else is joined, so nothing fans
    out; platforms are a small closed set. Member lists are ``cluster_members``.
    """
    linked = members.select("cluster_id", "post_id").join(posts, "post_id")
    per = linked.groupBy("cluster_id").agg(
        F.max(severity_rank(F.col("severity"))).alias("_sev"), F.count("post_id").alias("post_count"),
        F.sum("share_count").alias("_shares"), F.min("ts").alias("timestamp_earliest"),
        F.max("ts").alias("timestamp_latest"), F.array_sort(F.collect_set("platform")).alias("_platforms"),
    )
    names = incidents.select(F.col("id").alias("incident_id"), F.col("name").alias("incident_name"))
    return (
        clusters.join(names, "incident_id", "left").join(per, clusters["id"] == per["cluster_id"], "left")
        .select(
            F.col("id").alias("narrative_id"), F.col("summary").alias("narrative_summary"), "incident_id", "incident_name",
            _severity_name(F.col("_sev")).alias("severity"),
            F.coalesce("post_count", F.lit(0).cast("bigint")).alias("post_count"),
            F.coalesce("_shares", F.lit(0)).cast("bigint").alias("combined_shares"), "spread_status",
            "timestamp_earliest", "timestamp_latest",
            F.when(F.size("_platforms") > 0, F.col("_platforms")).alias("platforms"), "review_status",
        )
    )


def cluster_members(members: DataFrame, posts: DataFrame) -> DataFrame:
    """Posts of each narrative with their position by time: the scalable form of the id list."""
    linked = members.select("cluster_id", "post_id").join(posts.select("post_id", "ts"), "post_id")
    numbered = number_rows(linked, ["cluster_id", "ts", "post_id"], "_i")
    first = numbered.groupBy("cluster_id").agg(F.min("_i").alias("_first"))
    return numbered.join(first, "cluster_id").select(
        "cluster_id", (F.col("_i") - F.col("_first") + 1).alias("position"), "post_id"
    )


def narrative_items(members: DataFrame, posts: DataFrame, claims: DataFrame, facts: DataFrame) -> DataFrame:
    """Posts, key claims and matched facts of each narrative, one per row with its position.

    Posts come by time, claims by id, facts newest first. This is the form for
    narratives of any size: a list is never held in one task.
    """
    p = members.select("cluster_id", "post_id").join(posts.select("post_id", "ts"), "post_id")
    none = F.lit(None)
    newest = -F.unix_micros(F.col("timestamp").cast("timestamp"))
    parts = [
        p.select(F.col("cluster_id").alias("narrative_id"), F.lit("post").alias("kind"), F.unix_micros(F.col("ts").cast("timestamp")).alias("_o"), F.col("post_id").cast("bigint").alias("item_id"),
                 none.cast("string").alias("source"), F.col("ts").alias("timestamp"), none.cast("string").alias("content")),
        claims.select(F.col("narrative_cluster_id").alias("narrative_id"), F.lit("claim").alias("kind"), F.lit(0).cast("bigint").alias("_o"), F.col("id").cast("bigint").alias("item_id"),
                      none.cast("string").alias("source"), none.cast("timestamp_ntz").alias("timestamp"), "content"),
        facts.select(F.col("narrative_cluster_id").alias("narrative_id"), F.lit("fact").alias("kind"), newest.alias("_o"), F.col("id").cast("bigint").alias("item_id"), "source", "timestamp", "content"),
    ]
    numbered = number_rows(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["narrative_id", "kind", "_o", "item_id"], "_i")
    first = numbered.groupBy("narrative_id", "kind").agg(F.min("_i").alias("_first"))
    return numbered.join(first, ["narrative_id", "kind"]).select(
        "narrative_id", "kind", (F.col("_i") - F.col("_first") + 1).alias("position"), "item_id", "source", "timestamp", "content"
    )


def nest(rows: DataFrame, key: str, order: list[Column], value: Column, name: str) -> DataFrame:
    """Array of ``value`` per key in ``order`` for display; NULL where a key has no rows.

    An array lives in one task; ``narrative_items`` is the form without that bound.
    """
    item = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], value.alias("v"))
    return rows.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(item)), lambda s: s["v"]).alias(name))


def narrative_display(
    objects: DataFrame, members: DataFrame, posts: DataFrame, claims: DataFrame, facts: DataFrame
) -> DataFrame:
    """Narrative objects with the nested lists of the display view; ``narrative_items`` has them in long form."""
    linked = members.join(posts.select("post_id", "ts"), "post_id")
    ids = nest(linked, "cluster_id", [F.col("ts"), F.col("post_id")], F.col("post_id"), "post_ids")
    kc = nest(claims, "narrative_cluster_id", [F.col("id")], F.col("content"), "key_claims")
    newest = -F.unix_micros(F.col("timestamp").cast("timestamp"))
    mf = nest(
        facts, "narrative_cluster_id", [newest, F.col("id")], F.struct("source", "timestamp", "content"), "matched_facts"
    )
    nid = "narrative_id"
    return (
        objects.join(ids.withColumnRenamed("cluster_id", nid), nid, "left")
        .join(kc.withColumnRenamed("narrative_cluster_id", nid), nid, "left")
        .join(mf.withColumnRenamed("narrative_cluster_id", nid), nid, "left")
    )


def active_incident_objects(incidents: DataFrame, clusters: DataFrame, members: DataFrame, posts: DataFrame) -> DataFrame:
    """Active incidents: distinct posts, severity counts (not distinct) and the top threat.

    The top threat is the summary of the most severe post; ties take the first summary.
    """
    linked = (
        clusters.select(F.col("id").alias("cluster_id"), "incident_id", "summary")
        .join(members.select("cluster_id", "post_id"), "cluster_id", "left")
        .join(posts.select("post_id", "severity"), "post_id", "left")
        .withColumn("_known", F.when(F.col("severity").isNotNull(), F.col("post_id")))
    )
    sev = F.col("severity")
    rank = F.coalesce(severity_rank(sev), F.lit(0))
    per = linked.groupBy("incident_id").agg(
        F.countDistinct("_known").alias("total_flags"),
        F.count_if(sev == "CRITICAL").alias("critical"), F.count_if(sev == "HIGH").alias("high"),
        F.count_if(sev == "MEDIUM").alias("medium"), F.min(F.struct((-rank).alias("r"), F.col("summary"))).alias("_top"),
    )
    active = incidents.where("is_active").select(F.col("id").alias("incident_id"), F.col("name").alias("incident_name"))
    zero = F.lit(0).cast("bigint")
    return active.join(per, "incident_id", "left").select(
        "incident_id", "incident_name", F.coalesce("total_flags", zero).alias("total_flags"),
        *[F.coalesce(c, zero).alias(c) for c in ("critical", "high", "medium")], F.col("_top.summary").alias("top_threat"),
    )


def narrative_kpis(objects: DataFrame, now: Column, resolved: tuple[str, ...] = ("CORRECTION_PUBLISHED", "DISMISSED")) -> DataFrame:
    today = F.to_date("timestamp_latest") == F.to_date(now)
    return objects.agg(
        F.count_if(F.col("review_status") == "NEEDS_REVIEW").alias("needs_review"),
        F.count_if(F.col("severity") == "CRITICAL").alias("critical"),
        F.count_if(F.col("severity") == "HIGH").alias("high"),
        F.count_if(F.col("review_status").isin(*resolved) & today).alias("resolved_today"),
    )


def cluster_time_span(members: DataFrame, posts: DataFrame) -> DataFrame:
    return members.join(posts.select("post_id", "ts"), "post_id").groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("post_count"), F.min("ts").alias("timestamp_earliest"), F.max("ts").alias("timestamp_latest")
    )


def feed_filter(feed: DataFrame, view: str = "needs_review", platform: str = "all", query: str = "") -> DataFrame:
    """Narratives shown for a view, platform and search text, with the severity weight to sort by."""
    kept = feed
    if view != "all":
        status = F.lower(F.coalesce("review_status", F.lit("")))
        kept = kept.where(F.contains(status, F.lit("need")) | (status == "pending"))
    if platform in ("twitter", "facebook", "instagram"):
        label = F.lower(F.coalesce("platforms_label", F.lit("")))
        kept = kept.where((F.lower("platform") == platform) | F.contains(label, F.lit(platform)))
    text = query.strip().lower()
    if text:
        hay = F.lower(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in (
            "incident_name", "headline", "content", "platforms_label")]))
        kept = kept.where(F.contains(hay, F.lit(text)))
    weight = F.when(F.col("severity") == "critical", 3).when(F.col("severity") == "high", 2).when(F.col("severity") == "medium", 1)
    return kept.withColumn("severity_weight", weight)
