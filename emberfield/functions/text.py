"""Severity, spread and display rules on posts and narratives."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severities, platforms and review states in declaration order.
SEVERITY_RANK = {"MEDIUM": 1, "HIGH": 2, "CRITICAL": 3}
PLATFORMS = ["TWITTER", "FACEBOOK", "TIKTOK", "REDDIT"]
SPREAD_STATES = ["STEADY", "GROWING", "SPREADING_FAST"]
REVIEW_STATES = ["NEEDS_REVIEW", "DISMISSED", "CONFIRMED_MISINFORMATION", "CORRECTION_PUBLISHED"]


def severity_rank(severity: Column) -> Column:
    """Position in declaration order: text order would put MEDIUM above CRITICAL."""
    out = None
    for name, rank in SEVERITY_RANK.items():
        out = F.when(severity == name, rank) if out is None else out.when(severity == name, rank)
    return out


def severity_db(score: Column) -> Column:
    return F.when(score >= 0.8, "CRITICAL").when(score >= 0.5, "HIGH").otherwise("MEDIUM")


def severity_api(score: Column) -> Column:
    return (
        F.when(score >= 0.9, "CRITICAL").when(score >= 0.75, "HIGH").when(score >= 0.6, "MEDIUM").otherwise("LOW")
    )


def severity_of_probabilities(probabilities: Column) -> Column:
    """The service rates the largest class probability, whichever class it is."""
    return severity_api(F.array_max(F.map_values(probabilities)))


def spread_label(status: Column, shares: Column) -> Column:
    s = F.lower(F.coalesce(status, F.lit("")))
    return (
        F.when(F.contains(s, F.lit("fast")), "spreading fast")
        .when(F.contains(s, F.lit("grow")), "growing")
        .when(F.contains(s, F.lit("stable")) | F.contains(s, F.lit("steady")), "steady")
        .when(shares >= 2000, "spreading fast").when(shares >= 600, "growing").otherwise("steady")
    )


def normalise_severity(value: Column) -> Column:
    v = F.lower(F.coalesce(value, F.lit("")))
    return F.when(v.isin("crit", "critical"), "critical").when(v == "high", "high").otherwise("medium")


def first_known(*options: Column) -> Column:
    return F.coalesce(*options)


def headline(content: Column) -> Column:
    return F.when(F.length(content) > 120, F.concat(F.substring(content, 1, 120), F.lit("…"))).otherwise(content)


def platform_labels(platforms: Column) -> Column:
    return F.array_join(F.transform(
        platforms, lambda p: F.when(F.lower(p) == "twitter", "X / Twitter").otherwise(p)
    ), ", ")


def normalise_narrative(row: dict[str, Column]) -> dict[str, Column]:
    """Display fields from the alias columns that exist; ``row`` maps alias to column."""
    def pick(*names: str, default=None) -> Column:
        found = [row[n] for n in names if n in row]
        return F.coalesce(*found, F.lit(default)) if found else F.lit(default)

    content = pick("content", "text", "narrative_summary", "summary", default="")
    shares = pick("shares", "combined_shares", "share_count", "engagement", default=0).cast("bigint")
    status = F.lower(pick("spreadStatus", "spread_status", default=""))
    review = F.regexp_replace(F.lower(pick("reviewStatus", "review_status", "status", default="")), r"\s+", "_")
    return {
        "id": pick("id", "cluster_id", "narrative_id", "post_id", default="").cast("string"),
        "severity": normalise_severity(pick("severity")),
        "incident_id": pick("incidentId", "incident_id", default="").cast("string"),
        "incident_name": pick("incidentName", "incident_name", "location", default="Linked incident"),
        "headline": F.coalesce(pick("headline", "title"), headline(content)),
        "post_count": F.greatest(pick("postCount", "post_count", default=1).cast("bigint"), F.lit(1)),
        "platforms_label": platform_labels(row["platforms"]) if "platforms" in row else F.lit("Social"),
        "content": content, "shares": shares, "spread_status": status,
        "spread_label": F.coalesce(pick("spreadLabel"), spread_label(status, shares)),
        "review_status": F.when(review == "", "needs_review").otherwise(review),
    }


def normalise_incident(row: dict[str, Column]) -> dict[str, Column]:
    def pick(*names: str, default=None) -> Column:
        found = [row[n] for n in names if n in row]
        return F.coalesce(*found, F.lit(default)) if found else F.lit(default)

    def count(*names: str) -> Column:
        return pick(*names, default=0).cast("bigint")

    return {
        "id": pick("id", "incident_id", "incidentId", default="").cast("string"),
        "title": pick("title", "name", "incident_name", "incidentName", default="Incident"),
        "flag_count": count("flagCount", "flag_count", "total_flags"),
        "critical_count": count("criticalCount", "critical_count", "critical"),
        "high_count": count("highCount", "high_count", "high"),
        "medium_count": count("mediumCount", "medium_count", "medium"),
        "top_threat": pick("topThreat", "top_threat", default=""),
    }


def normalise_post(row: dict[str, Column]) -> dict[str, Column]:
    """Author, timestamp and shares under one name each, shares 0 when unknown."""
    def pick(*names: str, default=None) -> Column:
        found = [row[n] for n in names if n in row]
        return F.coalesce(*found, F.lit(default)) if found else F.lit(default)

    return {
        "id": pick("id", "post_id").cast("string"), "author": pick("author", "author_name", default=""),
        "platform": pick("platform", default=""), "content": pick("content", "text", default=""),
        "timestamp": pick("timestamp", "ts"), "shares": pick("shares", "share_count", default=0).cast("bigint"),
    }
