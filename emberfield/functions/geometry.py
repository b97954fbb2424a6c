"""Polygons as arrays of rings of {x, y} points, worked on with higher-order functions.

Even-odd counting over all rings covers holes and multi-part shapes. Points on a
west or south edge count as inside, on an east or north edge as outside.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"
RINGS = f"array<array<{POINT}>>"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body`` (a one-element transform)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def edges(ring: Column) -> Column:
    """Consecutive point pairs of a closed ring as {x1,y1,x2,y2}."""
    return let(ring, _edges)


def _edges(ring: Column) -> Column:
    n = F.size(ring)
    head = F.slice(ring, F.lit(1), F.greatest(n - 1, F.lit(0)))
    tail = F.slice(ring, F.lit(2), F.greatest(n - 1, F.lit(0)))
    return F.zip_with(head, tail, lambda a, b: F.struct(
        a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
    ))


def all_edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, edges))


def edges_contain(edge_list: Column, x: Column, y: Column) -> Column:
    """Ray casting to the right of the point over a flat edge array."""
    crossing = F.filter(
        edge_list,
        lambda e: ((e["y1"] > y) != (e["y2"] > y))
        & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]),
    )
    return F.coalesce(F.size(crossing) % 2 == 1, F.lit(False))


def contains_point(rings: Column, x: Column, y: Column) -> Column:
    return edges_contain(all_edges(rings), x, y)


def edge_hits_box(e: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Segment against closed box: the extents overlap and the box does not lie on one side of the line."""
    overlap = (
        (F.greatest(e["x1"], e["x2"]) >= x0) & (F.least(e["x1"], e["x2"]) <= x1)
        & (F.greatest(e["y1"], e["y2"]) >= y0) & (F.least(e["y1"], e["y2"]) <= y1)
    )
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    # distance of the box centre from the line against the reach of the box across it (both doubled)
    off = F.abs(dx * (y0 + y1 - e["y1"] * 2) - dy * (x0 + x1 - e["x1"] * 2))
    return overlap & (off <= (x1 - x0) * F.abs(dy) + (y1 - y0) * F.abs(dx))


def edges_touch_box(edge_list: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.coalesce(F.exists(edge_list, lambda e: edge_hits_box(e, x0, y0, x1, y1)), F.lit(False))


def edges_intersect_box(edge_list: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """True if the polygon and the closed box share a point."""
    return edges_touch_box(edge_list, x0, y0, x1, y1) | edges_contain(edge_list, (x0 + x1) / 2, (y0 + y1) / 2)


def intersects_box(rings: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return edges_intersect_box(all_edges(rings), x0, y0, x1, y1)


def bounds(rings: Column) -> Column:
    points = F.flatten(rings)
    xs, ys = points["x"], points["y"]
    return F.struct(
        F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"),
        F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"),
    )


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v)


def _local(rings: Column) -> Column:
    """{edges, x, y}: edges relative to the first vertex, so that large coordinates do not cancel."""
    first = F.get(F.get(rings, F.lit(0)), F.lit(0))
    return let(first, lambda o: F.struct(
        all_edges(F.transform(rings, lambda ring: F.transform(ring, lambda p: F.struct(
            (p["x"] - o["x"]).alias("x"), (p["y"] - o["y"]).alias("y")
        )))).alias("edges"),
        o["x"].alias("x"), o["y"].alias("y"),
    ))


def _cross(e: Column) -> Column:
    return e["x1"] * e["y2"] - e["x2"] * e["y1"]


def signed_area(rings: Column) -> Column:
    return let(_local(rings), lambda r: _sum(F.transform(r["edges"], _cross)) / 2)


def area(rings: Column) -> Column:
    """Outer rings counter-clockwise and holes clockwise (or the reverse) cancel as they should."""
    return F.abs(signed_area(rings))


def perimeter(rings: Column) -> Column:
    return _sum(F.transform(all_edges(rings), lambda e: F.sqrt(
        F.pow(e["x2"] - e["x1"], 2) + F.pow(e["y2"] - e["y1"], 2)
    )))


def centroid(rings: Column) -> Column:
    def of(r: Column) -> Column:
        es = r["edges"]
        three_a = _sum(F.transform(es, _cross)) * 3
        return F.struct(
            (r["x"] + _sum(F.transform(es, lambda e: (e["x1"] + e["x2"]) * _cross(e))) / three_a).alias("x"),
            (r["y"] + _sum(F.transform(es, lambda e: (e["y1"] + e["y2"]) * _cross(e))) / three_a).alias("y"),
        )

    return let(_local(rings), of)


def map_points(rings: Column, fn) -> Column:
    """Apply ``fn(x, y) -> (x, y)`` to every point, e.g. a projection."""
    def move(p: Column) -> Column:
        x, y = fn(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(rings, lambda ring: F.transform(ring, move))


def compactness(area_m2: Column, perimeter_m: Column) -> Column:
    return F.lit(4.0) * F.pi() * area_m2 / (perimeter_m * perimeter_m)


def _clip_half(ring: Column, axis: str, limit: Column, keep_above: bool) -> Column:
    """One Sutherland-Hodgman step against an axis-parallel line."""
    other = "y" if axis == "x" else "x"

    def inside(v: Column) -> Column:
        return v >= limit if keep_above else v <= limit

    def step(e: Column) -> Column:
        a, b = e[f"{axis}1"], e[f"{axis}2"]
        c, d = e[f"{other}1"], e[f"{other}2"]
        cut = c + (d - c) * (limit - a) / (b - a)
        at = F.struct(limit.alias("x"), cut.alias("y")) if axis == "x" else F.struct(cut.alias("x"), limit.alias("y"))
        end = F.struct(e["x2"].alias("x"), e["y2"].alias("y"))
        return (
            F.when(inside(a) & inside(b), F.array(end))
            .when(inside(a), F.array(at))
            .when(inside(b), F.array(at, end))
            .otherwise(F.array().cast(f"array<{POINT}>"))
        )

    def close(pts: Column) -> Column:
        return F.when(F.size(pts) > 0, F.concat(pts, F.slice(pts, 1, 1))).otherwise(pts)

    return let(F.flatten(F.transform(edges(ring), step)), close)


def clip_to_box(rings: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Each ring cut to the box; exact for area and centroid also where a ring is not convex."""
    def cut(ring: Column) -> Column:
        ring = _clip_half(ring, "x", x0, True)
        ring = _clip_half(ring, "x", x1, False)
        ring = _clip_half(ring, "y", y0, True)
        return _clip_half(ring, "y", y1, False)

    return F.filter(F.transform(rings, cut), lambda r: F.size(r) >= 4)


# -- text forms -------------------------------------------------------------

def parse_wkt(text: Column) -> Column:
    """POLYGON / MULTIPOLYGON text to rings."""
    ring_texts = F.regexp_extract_all(text, F.lit(r"\(([^()]+)\)"), F.lit(1))
    return F.transform(ring_texts, lambda r: F.transform(
        F.split(F.trim(r), r"\s*,\s*"),
        lambda p: F.struct(
            F.split(F.trim(p), r"\s+")[0].cast("double").alias("x"),
            F.split(F.trim(p), r"\s+")[1].cast("double").alias("y"),
        ),
    ))


def to_wkt(rings: Column) -> Column:
    return F.concat(F.lit("POLYGON ("), F.array_join(F.transform(rings, lambda r: F.concat(
        F.lit("("),
        F.array_join(F.transform(r, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ", "),
        F.lit(")"),
    )), ", "), F.lit(")"))


GEOJSON_POLYGON = "struct<type:string,coordinates:array<array<array<double>>>>"


def parse_geojson(text: Column) -> Column:
    """GeoJSON polygon text to rings; unreadable text gives NULL."""
    coords = F.from_json(text, GEOJSON_POLYGON)["coordinates"]
    return F.transform(coords, lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))


def geojson_polygon(rings: Column) -> Column:
    """Rings as a GeoJSON geometry struct ready for ``to_json``."""
    return F.struct(
        F.lit("Polygon").alias("type"),
        F.transform(rings, lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"]))).alias("coordinates"),
    )


def ring_min_corner(geojson: Column) -> Column:
    """Smallest longitude and latitude over all points, or NULLs for unreadable text."""
    pts = F.flatten(parse_geojson(geojson))
    return F.struct(
        F.array_min(F.transform(pts, lambda p: p["x"])).alias("lon"),
        F.array_min(F.transform(pts, lambda p: p["y"])).alias("lat"),
    )


GEOMETRY_ANY = (
    "struct<type:string,coordinates:string,"
    "geometries:array<struct<type:string,coordinates:string>>>"
)


def first_point(geometry_json: Column) -> Column:
    """{lat, lon} of a Point, or of the first usable Point of a GeometryCollection."""
    g = F.from_json(geometry_json, GEOMETRY_ANY)

    def coords(c: Column) -> Column:
        return F.from_json(c, "array<double>")

    parts = F.filter(
        g["geometries"], lambda p: (p["type"] == "Point") & (F.size(coords(p["coordinates"])) >= 2)
    )
    best = F.when(
        (g["type"] == "Point") & (F.size(coords(g["coordinates"])) >= 2), coords(g["coordinates"])
    ).when((g["type"] == "GeometryCollection") & (F.size(parts) > 0), coords(F.get(parts, F.lit(0))["coordinates"]))
    return F.struct(F.get(best, F.lit(1)).alias("lat"), F.get(best, F.lit(0)).alias("lon"))


def geometry_id(geojson: Column) -> Column:
    """SHA-256 of the canonical (sorted keys, compact) JSON text."""
    return F.sha2(F.to_json(F.parse_json(geojson)), 256)
