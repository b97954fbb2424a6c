"""The binding views as SQL common table expressions."""

from __future__ import annotations


def _lat(a: str, b: str) -> str:
    return f"((-39.6)::DOUBLE + ((({a}) * 7919 + ({b}) * 13) % 6000) / 1000.0::DOUBLE)"


def _lon(a: str, b: str) -> str:
    return f"(140.5::DOUBLE + ((({a}) * 104729 + ({b}) * 37) % 10000) / 1000.0::DOUBLE)"


def season(ts: str) -> str:
    return (
        f"CASE WHEN month({ts}) IN (12,1,2) THEN 'Summer' WHEN month({ts}) IN (3,4,5) THEN 'Autumn' "
        f"WHEN month({ts}) IN (6,7,8) THEN 'Winter' ELSE 'Spring' END"
    )


def haversine(lat1: str, lon1: str, lat2: str, lon2: str, radius: str = "6371.0") -> str:
    return (
        f"2*{radius}::DOUBLE*asin(least(sqrt(pow(sin(radians({lat2}-({lat1}))/2),2)+cos(radians({lat1}))*cos(radians({lat2}))"
        f"*pow(sin(radians({lon2}-({lon1}))/2),2)),1.0))"
    )


def euclid(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return f"sqrt(pow({lat1}-({lat2}),2)+pow({lon1}-({lon2}),2))"


def equirect(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return f"sqrt(pow(({lat2}-({lat1}))*111.32,2)+pow(({lon2}-({lon1}))*111.32*cos(radians({lat1})),2))"


SIZE_CLASS = (
    "CASE WHEN {a} <= 0 THEN NULL WHEN {a} <= 10 THEN 'small' WHEN {a} <= 100 THEN 'medium' "
    "WHEN {a} <= 1000 THEN 'large' ELSE 'mega' END"
)

VIEWS = {
    "ev": "SELECT event_id, ts, user_id, event_type, value, regexp_extract(props, '(\\d+)', 1)::BIGINT AS k FROM events",
    "hot": f"""SELECT event_id, ts, user_id, k, event_type AS satellite, value AS frp,
        {_lat('user_id', 'k')} AS lat, {_lon('user_id', 'k')} AS lon,
        CASE WHEN hour(ts) < 12 THEN 'D' ELSE 'N' END AS daynight, user_id % 10 AS cell_x, k % 10 AS cell_y,
        ts::DATE AS acq_date, strftime(ts, '%H%M') AS acq_time, 300.0::DOUBLE + (k % 50) AS brightness,
        CASE WHEN event_id % 13 <> 0 THEN 280.0::DOUBLE + (user_id % 20) END AS bright_t31,
        CASE WHEN k % 3 = 0 THEN 'l' WHEN k % 3 = 1 THEN 'n' ELSE 'h' END AS band FROM ev""",
    "fires0": f"""SELECT o_orderkey AS fire_id, o_orderdate AS ignition_date,
        o_totalprice / pow(10.0::DOUBLE, 2 + o_orderkey % 4) AS area_ha,
        CASE o_orderstatus WHEN 'F' THEN 'Bushfire' WHEN 'P' THEN 'Planned Burn' ELSE 'Unknown' END AS fire_type,
        {_lat('o_orderkey', 'o_custkey % 100')} AS lat, {_lon('o_orderkey', 'o_custkey % 100')} AS lon,
        0.01037::DOUBLE + (o_orderkey % 4) * 0.01::DOUBLE AS half FROM orders""",
    "fires": f"SELECT *, {season('ignition_date')} AS season, {SIZE_CLASS.format(a='area_ha')} AS size_class FROM fires0",
    "fire_det": """SELECT l_orderkey AS fire_id, o_orderdate AS ignition_date,
        o_orderdate + to_days(((l_partkey*7 + l_linenumber*3) % 14 - 2 + CASE WHEN l_partkey % 50 = 0 THEN 200 ELSE 0 END)::INT)
        AS datetime, l_quantity AS frp_peak, l_extendedprice / 1000.0::DOUBLE AS frp_cumulative
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "obs": """SELECT l_suppkey AS cell, l_shipdate AS ts, max(l_quantity) AS quantity, max(l_extendedprice) AS price,
        max(l_discount) AS discount, max(l_tax) AS tax, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS is_burning
        FROM lineitem GROUP BY 1, 2""",
    "registry": f"""SELECT c_custkey + 1 AS location_id, {_lat('c_custkey', 'c_custkey % 100')} AS grid_latitude,
        {_lon('c_custkey', 'c_custkey % 100')} AS grid_longitude, c_mktsegment AS region_name, c_custkey % 50 AS grid_row,
        c_custkey // 50 AS grid_col FROM customer""",
    "facility": f"""SELECT c_custkey AS _id, c_name AS facility_name, c_mktsegment AS lga,
        'Road ' || (c_custkey % 40)::VARCHAR AS facility_address, 'Town ' || c_nationkey::VARCHAR AS suburb,
        CASE WHEN c_custkey % 17 <> 0 THEN {_lat('c_custkey*3+1', 'c_custkey % 77')} END AS latitude,
        CASE WHEN c_custkey % 17 <> 0 THEN {_lon('c_custkey*3+1', 'c_custkey % 77')} END AS longitude FROM customer""",
    "pred": """SELECT event_id, CASE WHEN satellite = 'error' THEN 1 ELSE 0 END AS y, k / 99.0::DOUBLE AS p, cell_x, cell_y,
        satellite, daynight, k FROM hot""",
    "posts": """SELECT doc_id AS post_id, (n_chars % 11) / 10.0::DOUBLE AS score, n_chars AS share_count,
        CASE doc_id % 4 WHEN 0 THEN 'TWITTER' WHEN 1 THEN 'FACEBOOK' WHEN 2 THEN 'TIKTOK' ELSE 'REDDIT' END AS platform,
        TIMESTAMP '2024-01-01' + to_minutes(doc_id::INT) AS ts,
        CASE WHEN (n_chars % 11) >= 8 THEN 'CRITICAL' WHEN (n_chars % 11) >= 5 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
        CASE WHEN (n_chars % 11) >= 8 THEN 3 WHEN (n_chars % 11) >= 5 THEN 2 ELSE 1 END AS sev,
        source AS author_name, text AS content FROM documents""",
    "members": """SELECT DISTINCT conv_id AS cluster_id, (conv_id * 8 + turn) % (SELECT count(*) FROM documents) AS post_id
        FROM conversations""",
    "clusters": """SELECT DISTINCT conv_id AS id, 'Narrative ' || conv_id::VARCHAR AS summary, (conv_id % 25)::INT AS incident_id,
        CASE conv_id % 3 WHEN 0 THEN 'STEADY' WHEN 1 THEN 'GROWING' ELSE 'SPREADING_FAST' END AS spread_status,
        CASE conv_id % 4 WHEN 0 THEN 'NEEDS_REVIEW' WHEN 1 THEN 'DISMISSED' WHEN 2 THEN 'CONFIRMED_MISINFORMATION'
        ELSE 'CORRECTION_PUBLISHED' END AS review_status FROM conversations""",
    "incidents": "SELECT n_nationkey AS id, n_name AS name, n_nationkey % 3 <> 0 AS is_active FROM nation",
    "hot_in": """SELECT *, round_even(lat/0.1, 0)::BIGINT AS lat_idx, round_even(lon/0.1, 0)::BIGINT AS lon_idx
        FROM hot WHERE lat BETWEEN -39.2 AND -33.98 AND lon BETWEEN 141.0 AND 150.0""",
    "loc": """SELECT row_number() OVER (ORDER BY lat_idx, lon_idx) AS location_id, lat_idx, lon_idx
        FROM (SELECT DISTINCT lat_idx, lon_idx FROM hot_in)""",
    "tim": f"""SELECT row_number() OVER (ORDER BY h) AS time_id, h AS datetime_record, {season('h')} AS season
        FROM (SELECT DISTINCT date_trunc('hour', ts) AS h FROM hot_in)""",
}

NEEDS = {
    "hot": ["ev"], "fires": ["fires0"], "pred": ["hot"], "hot_in": ["hot"], "loc": ["hot_in"], "tim": ["hot_in"],
}


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []
    for n in names:
        for m in [*_closure(NEEDS.get(n, [])), n]:
            if m not in out:
                out.append(m)
    return out


def with_views(names: str, body: str) -> str:
    """``body`` preceded by the named views; a body may start with its own ``, name AS (...)`` list."""
    views = _closure(names.split())
    if not views:
        text = body.strip()
        return "WITH " + text[1:].strip() if text.startswith(",") else text
    head = "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in views)
    body = body.strip()
    return head + ("\n" if not body.startswith(",") else "") + body
