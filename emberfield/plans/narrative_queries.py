"""Posts, narratives, incidents and feed queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberfield.functions import text, time
from emberfield.operators import narratives, quality
from emberfield.plans.bindings import Tables
from emberfield.plans.registry import query

_OBJ = """
, pp AS (SELECT cluster_id, p.* FROM members m JOIN posts p USING (post_id)),
ag AS (SELECT cluster_id, max(sev) AS sv, count(*) AS post_count, sum(share_count)::BIGINT AS combined_shares, min(ts) AS timestamp_earliest, max(ts) AS timestamp_latest,
 string_agg(DISTINCT platform, ',' ORDER BY platform) AS platforms FROM pp GROUP BY 1),
ob AS (SELECT c.id AS narrative_id, c.summary AS narrative_summary, c.incident_id, i.name AS incident_name, CASE sv WHEN 3 THEN 'CRITICAL' WHEN 2 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' END AS severity,
 coalesce(post_count,0) AS post_count, coalesce(combined_shares,0) AS combined_shares, spread_status, timestamp_earliest, timestamp_latest, platforms, review_status
 FROM clusters c LEFT JOIN incidents i ON i.id = c.incident_id LEFT JOIN ag ON ag.cluster_id = c.id)"""
_V = "posts members clusters incidents"


def _objects(t: Tables):
    return narratives.narrative_cluster_objects(t.clusters, t.incidents, t.members, t.posts)


@query("narrative_cluster_objects", _OBJ + "SELECT * FROM ob", _V)
def narrative_cluster_objects(t: Tables):
    return _objects(t).withColumn("platforms", F.array_join("platforms", ","))


@query("narrative_cluster_members", """
SELECT cluster_id, row_number() OVER (PARTITION BY cluster_id ORDER BY ts, post_id) AS position, post_id FROM members JOIN posts USING (post_id)""", _V)
def narrative_cluster_members(t: Tables):
    return narratives.cluster_members(t.members, t.posts)


@query("narrative_display", _OBJ + """
, ids AS (SELECT cluster_id, string_agg(post_id::VARCHAR, ',' ORDER BY ts, post_id) AS post_ids FROM pp GROUP BY 1),
kc AS (SELECT conv_id, string_agg(left(text,20), '|' ORDER BY turn) AS key_claims FROM conversations WHERE role = 'user' GROUP BY 1),
mf AS (SELECT conv_id, string_agg(left(text,10), '|' ORDER BY turn DESC) AS matched_facts FROM conversations WHERE role = 'assistant' GROUP BY 1)
SELECT narrative_id, severity, post_ids, key_claims, matched_facts FROM ob LEFT JOIN ids ON ids.cluster_id = narrative_id LEFT JOIN kc ON kc.conv_id = narrative_id
LEFT JOIN mf ON mf.conv_id = narrative_id""", _V)
def narrative_display(t: Tables):
    claims, facts = _claims_and_facts(t)
    out = narratives.narrative_display(_objects(t), t.members, t.posts, claims, facts)
    return out.select("narrative_id", "severity", F.array_join(F.col("post_ids").cast("array<string>"), ",").alias("post_ids"),
                      F.array_join("key_claims", "|").alias("key_claims"),
                      F.array_join(F.transform("matched_facts", lambda f: f["content"]), "|").alias("matched_facts"))


def _claims_and_facts(t: Tables):
    conv = t.table("conversations")
    claims = conv.where("role = 'user'").select(F.col("conv_id").alias("narrative_cluster_id"), F.col("turn").alias("id"), F.left("text", F.lit(20)).alias("content"))
    stamp = F.lit("2024-01-01").cast(time.NTZ) + F.make_dt_interval(F.lit(0), F.lit(0), F.col("turn").cast("int"))
    facts = conv.where("role = 'assistant'").select(F.col("conv_id").alias("narrative_cluster_id"), F.col("turn").alias("id"), F.col("role").alias("source"),
                                                     stamp.alias("timestamp"), F.left("text", F.lit(10)).alias("content"))
    return claims, facts


@query("narrative_items", """
SELECT cluster_id AS narrative_id, 'post' AS kind, row_number() OVER (PARTITION BY cluster_id ORDER BY ts, post_id) AS position, post_id AS item_id, NULL::VARCHAR AS content FROM members JOIN posts USING (post_id)
UNION ALL SELECT conv_id, 'claim', row_number() OVER (PARTITION BY conv_id ORDER BY turn), turn, left(text,20) FROM conversations WHERE role = 'user'
UNION ALL SELECT conv_id, 'fact', row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC), turn, left(text,10) FROM conversations WHERE role = 'assistant'""", _V)
def narrative_items(t: Tables):
    return narratives.narrative_items(t.members, t.posts, *_claims_and_facts(t)).select("narrative_id", "kind", "position", "item_id", "content")


@query("active_incident_objects", """
, l AS (SELECT c.incident_id, c.summary, p.post_id, p.severity, coalesce(p.sev,0) AS sev FROM clusters c LEFT JOIN members m ON m.cluster_id = c.id LEFT JOIN posts p USING (post_id))
SELECT i.id AS incident_id, i.name AS incident_name, count(DISTINCT post_id) AS total_flags, count(*) FILTER (severity='CRITICAL') AS critical,
 count(*) FILTER (severity='HIGH') AS high, count(*) FILTER (severity='MEDIUM') AS medium, arg_min(summary, (-sev, summary)) AS top_threat
FROM incidents i LEFT JOIN l ON l.incident_id = i.id WHERE is_active GROUP BY 1,2""", _V)
def active_incident_objects(t: Tables):
    return narratives.active_incident_objects(t.incidents, t.clusters, t.members, t.posts)


@query("narrative_kpis", _OBJ + """
SELECT count(*) FILTER (review_status='NEEDS_REVIEW') AS needs_review, count(*) FILTER (severity='CRITICAL') AS critical, count(*) FILTER (severity='HIGH') AS high,
 count(*) FILTER (review_status IN ('CORRECTION_PUBLISHED','DISMISSED') AND timestamp_latest::DATE = DATE '2024-01-01') AS resolved_today FROM ob""", _V)
def narrative_kpis(t: Tables):
    return narratives.narrative_kpis(_objects(t), F.lit("2024-01-01 12:00:00").cast(time.NTZ))


@query("cluster_time_span", """
SELECT cluster_id, count(*) AS post_count, min(ts) AS timestamp_earliest, max(ts) AS timestamp_latest FROM members JOIN posts USING (post_id) GROUP BY 1""", _V)
def cluster_time_span(t: Tables):
    return narratives.cluster_time_span(t.members, t.posts)


@query("severity_db", "SELECT severity, count(*) AS n FROM posts GROUP BY 1", "posts")
def severity_db(t: Tables):
    return t.posts.groupBy(text.severity_db(F.col("score")).alias("severity")).agg(F.count(F.lit(1)).alias("n"))


@query("severity_api", """
SELECT post_id, CASE WHEN m >= 0.9 THEN 'CRITICAL' WHEN m >= 0.75 THEN 'HIGH' WHEN m >= 0.6 THEN 'MEDIUM' ELSE 'LOW' END AS severity
FROM (SELECT post_id, greatest(score, 1-score) AS m FROM posts)""", "posts")
def severity_api(t: Tables):
    probs = F.create_map(F.lit("misinformation"), F.col("score"), F.lit("credible"), 1 - F.col("score"))
    return t.posts.select("post_id", text.severity_of_probabilities(probs).alias("severity"))


@query("spread_label", """
SELECT post_id, CASE WHEN post_id % 5 = 0 THEN 'spreading fast' WHEN post_id % 5 = 1 THEN 'growing' WHEN post_id % 5 = 2 THEN 'steady'
 WHEN share_count >= 2000 THEN 'spreading fast' WHEN share_count >= 600 THEN 'growing' ELSE 'steady' END AS label FROM posts""", "posts")
def spread_label(t: Tables):
    k = F.col("post_id") % 5
    status = F.when(k == 0, "SPREADING_FAST").when(k == 1, "GROWING").when(k == 2, "stable").when(k == 3, "odd")
    return t.posts.select("post_id", text.spread_label(status, F.col("share_count")).alias("label"))


_NORM = """
, nn AS (SELECT post_id::VARCHAR AS id, CASE severity WHEN 'CRITICAL' THEN 'critical' WHEN 'HIGH' THEN 'high' ELSE 'medium' END AS severity, 'Linked incident' AS incident_name,
 CASE WHEN length(content) > 120 THEN left(content,120) || '…' ELSE content END AS headline, CASE WHEN platform = 'TWITTER' THEN 'X / Twitter' ELSE platform END AS platforms_label,
 lower(platform) AS platform, content, share_count AS shares, CASE WHEN share_count >= 2000 THEN 'spreading fast' WHEN share_count >= 600 THEN 'growing' ELSE 'steady' END AS spread_label,
 CASE WHEN post_id % 2 = 0 THEN 'needs_review' ELSE 'dismissed' END AS review_status FROM posts)"""


def _normalised(t: Tables):
    p = t.posts.withColumns({"platforms": F.array("platform"), "status": F.when(F.col("post_id") % 2 == 0, "Needs  Review").otherwise("Dismissed")})
    cols = text.normalise_narrative({
        "post_id": F.col("post_id"), "severity": F.col("severity"), "content": F.col("content"), "share_count": F.col("share_count"),
        "platforms": F.col("platforms"), "status": F.col("status"),
    })
    return p.select(*[c.alias(n) for n, c in cols.items()], F.lower("platform").alias("platform"))


@query("normalise_narrative", _NORM + "SELECT id, severity, incident_name, headline, platforms_label, shares, spread_label, review_status FROM nn", "posts")
def normalise_narrative(t: Tables):
    return _normalised(t).select("id", "severity", "incident_name", "headline", "platforms_label", "shares", "spread_label", "review_status")


@query("feed_filter", _NORM + """
SELECT id, severity, CASE severity WHEN 'critical' THEN 3 WHEN 'high' THEN 2 ELSE 1 END AS severity_weight FROM nn
WHERE review_status LIKE '%need%' AND platform = 'twitter' AND contains(lower('Linked incident ' || headline || ' ' || content || ' ' || platforms_label), 'the')""", "posts")
def feed_filter(t: Tables):
    return narratives.feed_filter(_normalised(t), "needs_review", "twitter", " The ").select("id", "severity", "severity_weight")


@query("feed_filter_all", _NORM + """
SELECT id, CASE severity WHEN 'critical' THEN 3 WHEN 'high' THEN 2 ELSE 1 END AS severity_weight FROM nn WHERE contains(lower('Linked incident ' || headline || ' ' || content || ' ' || platforms_label), 'ou')""", "posts")
def feed_filter_all(t: Tables):
    return narratives.feed_filter(_normalised(t), "all", "all", "ou").select("id", "severity_weight")


@query("limit_incidents", "SELECT id, name FROM incidents WHERE is_active ORDER BY id LIMIT 3", "incidents")
def limit_incidents(t: Tables):
    return t.incidents.where("is_active").select("id", "name").orderBy("id").limit(3)


@query("normalise_incident", """
SELECT i.id::VARCHAR AS id, coalesce(i.name,'Incident') AS title, count(c.id) AS flag_count, 0::BIGINT AS critical_count, '' AS top_threat
FROM incidents i LEFT JOIN clusters c ON c.incident_id = i.id GROUP BY 1,2""", "incidents clusters")
def normalise_incident(t: Tables):
    n = t.clusters.groupBy(F.col("incident_id").alias("id")).agg(F.count(F.lit(1)).alias("total_flags"))
    src = t.incidents.join(n, "id", "left")
    cols = text.normalise_incident({"id": F.col("id"), "name": F.col("name"), "total_flags": F.col("total_flags")})
    return src.select(*[cols[c].alias(c) for c in ("id", "title", "flag_count", "critical_count", "top_threat")])


@query("normalise_post", "SELECT post_id::VARCHAR AS id, author_name AS author, platform, ts AS timestamp, share_count AS shares FROM posts", "posts")
def normalise_post(t: Tables):
    cols = text.normalise_post({c: F.col(c) for c in ("post_id", "author_name", "platform", "ts", "share_count")})
    return t.posts.select(*[cols[c].alias(c) for c in ("id", "author", "platform", "timestamp", "shares")])


@query("relative_time", """
, m AS (SELECT event_id, epoch(TIMESTAMP '2024-01-31' - ts)/60.0 AS mi FROM hot)
SELECT event_id, CASE WHEN floor(mi+0.5) < 60 THEN floor(mi+0.5)::BIGINT::VARCHAR || ' min ago' ELSE floor(floor(mi+0.5)/60.0+0.5)::BIGINT::VARCHAR || ' hr ago' END AS label FROM m""", "hot")
def relative_time(t: Tables):
    mins = time.seconds_between(F.col("ts"), F.lit("2024-01-31").cast(time.NTZ)) / 60
    return t.hot.select("event_id", time.relative_label(mins).alias("label"))


@query("narrative_output", """
, bad AS (SELECT DISTINCT conv_id AS cluster_id, CASE WHEN conv_id % 50 = 0 THEN -conv_id - 1 ELSE (conv_id*8+turn) % (SELECT count(*) FROM documents) END AS post_id FROM conversations)
SELECT (SELECT count(*) FROM bad WHERE post_id NOT IN (SELECT doc_id FROM documents)) AS unknown_posts,
 (SELECT count(*) FROM (SELECT post_id FROM bad GROUP BY 1 HAVING count(*) > 1)) AS duplicate_posts,
 (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT post_id FROM bad)) AS unassigned_posts""")
def narrative_output(t: Tables):
    docs = t.table("documents").agg(F.count(F.lit(1))).scalar()
    c = F.col("conv_id")
    bad = t.table("conversations").select(c.alias("cluster_id"), F.when(c % 50 == 0, -c - 1).otherwise((c * 8 + F.col("turn")) % docs).alias("post_id")).distinct()
    return quality.narrative_output(t.posts.select("post_id"), bad)
