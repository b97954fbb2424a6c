"""Nearest and polygon joins against brute force, projections against known values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from emberfield.functions import geometry, grid
from emberfield.operators import hubs, interpolation, nearest, polygons


def _cloud(spark, seed):
    rng = np.random.default_rng(seed)
    p = pd.DataFrame({"plat": rng.uniform(-39, -34, 300).round(3), "plon": rng.uniform(141, 150, 300).round(3)})
    crowd = 1500  # most targets sit in one place
    t = pd.DataFrame({
        "grid_latitude": np.r_[rng.uniform(-39, -34, 300), rng.normal(-37, 0.0005, crowd)].round(5),
        "grid_longitude": np.r_[rng.uniform(141, 150, 300), rng.normal(145, 0.0005, crowd)].round(5),
    })
    t["location_id"] = np.arange(len(t))
    return p, t, spark.createDataFrame(p), spark.createDataFrame(t)


def _deltas(p, t):
    return t.grid_latitude.values[None, :] - p.plat.values[:, None], t.grid_longitude.values[None, :] - p.plon.values[:, None]


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_matches_brute_force(spark, k):
    p, t, sp, st = _cloud(spark, 1)
    dy, dx = _deltas(p, t)
    out = nearest.nearest_join(sp, st, ("plat", "plon"), ("grid_latitude", "grid_longitude"), "location_id", k=k).toPandas()
    got = out.sort_values(["plat", "plon", "rank"]).distance.values
    want = pd.DataFrame(np.sort(np.sqrt(dy**2 + dx**2), axis=1)[:, :k]).assign(a=p.plat, b=p.plon).drop_duplicates(["a", "b"])
    want = want.sort_values(["a", "b"])[list(range(k))].values.ravel()
    assert np.allclose(got, want, atol=0)


def test_a_third_of_the_targets_in_ten_metres(spark):
    rng = np.random.default_rng(9)
    here = np.array([-37.0, 145.0])
    crowd = here + rng.integers(0, 10_000, (3000, 2)) * 1e-8  # below the smallest cell of the first levels
    t = pd.DataFrame(np.r_[crowd, rng.uniform([-39, 141], [-34, 150], (6000, 2))], columns=["grid_latitude", "grid_longitude"])
    t["location_id"] = np.arange(len(t))
    p = pd.DataFrame(np.r_[here + rng.integers(0, 20_000, (400, 2)) * 1e-8, rng.uniform([-39, 141], [-34, 150], (800, 2))], columns=["plat", "plon"])
    out = nearest.nearest_join(spark.createDataFrame(p), spark.createDataFrame(t), ("plat", "plon"), ("grid_latitude", "grid_longitude"), "location_id").toPandas()
    dy, dx = _deltas(p, t)
    best = pd.Series(np.sqrt(dy**2 + dx**2).min(axis=1), index=pd.MultiIndex.from_frame(p))
    assert len(out) == len(best) and all(abs(r.distance - best[(r.plat, r.plon)]) < 1e-13 for r in out.itertuples())


def test_nearest_by_great_circle_and_groups(spark):
    p, t, sp, st = _cloud(spark, 2)
    sp = sp.withColumn("day", (F.col("plat") * 1000).cast("int") % 3)
    st = st.withColumn("day", F.col("location_id").cast("int") % 3 - 2)
    out = nearest.nearest_join(sp, st, ("plat", "plon"), ("grid_latitude", "grid_longitude"), "location_id", nearest.HAVERSINE_KM, by=["day"]).toPandas()
    dy, dx = _deltas(p, t)
    h = np.sin(np.radians(dy) / 2) ** 2 + np.cos(np.radians(p.plat.values))[:, None] * np.cos(np.radians(t.grid_latitude.values)) * np.sin(np.radians(dx) / 2) ** 2
    d = 2 * 6371 * np.arcsin(np.sqrt(h))
    tday = t.location_id.values % 3 - 2
    rows = {(r.plat, r.plon): r for r in out.itertuples()}
    for i, (a, b) in enumerate(p.values):
        r = rows.get((a, b))
        if r is not None:
            assert abs(r.distance - d[i][tday == r.day].min()) < 1e-9


def test_windowed_registry_is_not_the_global_nearest(spark):
    pts = spark.createDataFrame([(-37.0, 145.0), (-37.5, 145.0), (-30.0, 145.0)], "latitude double, longitude double")
    reg = spark.createDataFrame(
        [(1, -37.0195, 145.0195), (2, -37.0, 145.0205), (3, -37.9, 145.9)], "location_id long, grid_latitude double, grid_longitude double")
    out = {r.latitude: r for r in nearest.nearest_registry_windowed(pts, reg, ("latitude", "longitude")).collect()}
    assert out[-37.0].location_id == 1  # row 2 is closer but outside the first window
    assert out[-37.5].location_id is None and -30.0 not in out


def _ring_polygon(rng, n):
    rows = []
    for i in range(n):
        cx, cy, m = rng.uniform(0, 10), rng.uniform(0, 10), int(rng.integers(5, 120))
        ang = np.sort(rng.uniform(0, 2 * np.pi, m))
        r = rng.uniform(0.05, 1.5, m)
        xs, ys = cx + r * np.cos(ang), cy + r * np.sin(ang)
        ring = [{"x": float(x), "y": float(y)} for x, y in zip(xs, ys)]
        rows.append((i, [ring + ring[:1]]))
    return rows


def _contains(ring, x, y):
    odd = False
    for a, b in zip(ring[:-1], ring[1:]):
        if (a["y"] > y) != (b["y"] > y) and x < (b["x"] - a["x"]) * (y - a["y"]) / (b["y"] - a["y"]) + a["x"]:
            odd = not odd
    return odd


def test_point_in_polygon_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    shapes = _ring_polygon(rng, 25)
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-1, 11, (400, 2)))]
    polys = spark.createDataFrame(shapes, f"pid int, rings {geometry.RINGS}")
    points = spark.createDataFrame(pts, "id int, x double, y double")
    want = {(i, pid) for i, x, y in pts for pid, rings in shapes if _contains(rings[0], x, y)}
    for size in (0.3, 2.0):
        got = polygons.points_in_polygons(points, polys, "x", "y", "rings", size).select("id", "pid").collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want
    semi = polygons.points_in_polygons(points, polys, "x", "y", "rings", 0.3, "left_semi")
    assert {r.id for r in semi.collect()} == {i for i, _ in want}
    left = polygons.points_in_polygons(points, polys, "x", "y", "rings", 0.3, "left")
    assert left.where("pid is null").count() == len(pts) - len({i for i, _ in want})


def _wavy(n, cx, cy, radius, seed):
    """A closed outline of n short edges, star-shaped around a centre: its angles and radii, and the ring."""
    angle = np.linspace(0, 2 * np.pi, n, endpoint=False)
    r = radius * (1 + 0.2 * np.sin(7 * angle)) + np.random.default_rng(seed).uniform(0, radius * 1e-4, n)
    x, y = cx + r * np.cos(angle), cy + r * np.sin(angle)
    ring = [(float(a), float(b)) for a, b in zip(x, y)]
    return x, y, [*ring, ring[0]]


def _inside_star(x, y, cx, cy, px, py):
    """The edge in a place's direction tells whether it is inside."""
    n = len(x)
    i = (np.floor(np.arctan2(py - cy, px - cx) % (2 * np.pi) / (2 * np.pi) * n).astype(int)) % n
    j = (i + 1) % n
    return (x[j] - x[i]) * (py - y[i]) - (y[j] - y[i]) * (px - x[i]) > 0


def test_crowded_bucket_is_divided(spark):
    """200,000 edges and 100,000 points in one bucket, small shapes beside them and a wide one over it."""
    x, y, ring = _wavy(200_000, 0.5, 0.5, 0.3, 7)
    small = [[(0.1 * i, 0.1 * i), (0.1 * i + 0.05, 0.1 * i), (0.1 * i + 0.05, 0.1 * i + 0.05), (0.1 * i, 0.1 * i)] for i in range(8)]
    wide = [(-9.0, -9.0), (9.0, -9.0), (9.0, 0.55), (-9.0, 0.55), (-9.0, -9.0)]
    polys = spark.createDataFrame([(i, [r]) for i, r in enumerate([ring, wide, *small])], f"pid int, rings {geometry.RINGS}")
    rng = np.random.default_rng(8)
    near = rng.integers(0, len(x), 50_000)
    px = np.r_[rng.uniform(0, 1, 50_000), x[near] + rng.normal(0, 1e-3, 50_000)]
    py = np.r_[rng.uniform(0, 1, 50_000), y[near] + rng.normal(0, 1e-3, 50_000)]
    points = spark.createDataFrame(pd.DataFrame({"id": np.arange(len(px)), "x": px, "y": py})).repartition(8)
    cells, divided = polygons._leaves(*polygons._shapes(polys, "rings", 1.0), 1.0)
    assert divided and cells.agg(F.max(F.size("_e"))).first()[0] <= 256
    got = polygons.points_in_polygons(points, polys, "x", "y", "rings", 1.0).select("id", "pid").toPandas()
    assert not got.duplicated().any()
    want = {0: np.flatnonzero(_inside_star(x, y, 0.5, 0.5, px, py)), 1: np.flatnonzero(py < 0.55)}
    want |= {i + 2: np.flatnonzero(_inside([{"x": a, "y": b} for a, b in r], px, py)) for i, r in enumerate(small)}
    for pid, ids in want.items():
        assert np.array_equal(np.sort(got.id[got.pid == pid]), ids), pid
    left = polygons.points_in_polygons(points, polys.where("pid = 0"), "x", "y", "rings", 1.0, "left")
    assert left.agg(F.count("*"), F.count("pid")).first() == (len(px), len(want[0]))
    assert polygons.points_in_polygons(points, polys.where("pid = 0"), "x", "y", "rings", 1.0, "left_semi").count() == len(want[0])


def test_boxes_in_a_crowded_bucket(spark):
    """Boxes of several sizes against an outline of 3,000 edges and small shapes, by brute force."""
    x, y, ring = _wavy(3_000, 0.5, 0.5, 0.3, 9)
    small = [[(0.2 * i, 0.0), (0.2 * i + 0.1, 0.0), (0.2 * i + 0.1, 0.2), (0.2 * i, 0.2), (0.2 * i, 0.0)] for i in range(5)]
    polys = spark.createDataFrame([(i, [r]) for i, r in enumerate([ring, *small])], f"pid int, rings {geometry.RINGS}")
    rng = np.random.default_rng(10)
    corner, side = rng.uniform(-0.5, 1.2, (300, 2)), rng.choice([0.001, 0.02, 0.3, 2.5], (300, 2))
    boxes = pd.DataFrame({"id": np.arange(300), "w": corner[:, 0], "s": corner[:, 1], "e": corner[:, 0] + side[:, 0], "n": corner[:, 1] + side[:, 1]})
    got = polygons.boxes_intersect_polygons(spark.createDataFrame(boxes), polys, ("w", "s", "e", "n"), "rings", 1.0).select("id", "pid").toPandas()
    assert not got.duplicated().any()
    table = spark.createDataFrame(boxes).crossJoin(polys).where(geometry.intersects_box(F.col("rings"), F.col("w"), F.col("s"), F.col("e"), F.col("n")))
    want = {(r.id, r.pid) for r in table.select("id", "pid").collect()}
    assert {(int(a), int(b)) for a, b in got.to_numpy()} == want


def test_clip_cells(spark):
    ring = [{"x": 0.5, "y": 0.5}, {"x": 2.5, "y": 0.5}, {"x": 2.5, "y": 1.5}, {"x": 0.5, "y": 1.5}, {"x": 0.5, "y": 0.5}]
    boundary = spark.createDataFrame([([ring],)], f"rings {geometry.RINGS}")
    cells = spark.createDataFrame([(float(x), float(y), float(x + 1), float(y + 1)) for x in range(4) for y in range(3)], "w double, s double, e double, n double")
    out = {(r.w, r.s): r for r in polygons.clip_cells(cells, boundary, ("w", "s", "e", "n"), "rings", 1.0).collect()}
    assert len(out) == 6 and abs(sum(r.clipped_area for r in out.values()) - 2.0) < 1e-9
    assert abs(out[(0.0, 0.0)].clipped_area - 0.25) < 1e-9 and abs(out[(0.0, 0.0)].centroid_x - 0.75) < 1e-9


def _star(n, cx, cy, low, high, seed):
    """A closed outline of n edges around a centre, its radius jumping between low and high."""
    rng = np.random.default_rng(seed)
    angle = np.linspace(0, 2 * np.pi, n, endpoint=False)
    radius = rng.uniform(low, high, n)
    ring = [{"x": float(cx + r * np.cos(a)), "y": float(cy + r * np.sin(a))} for a, r in zip(angle, radius)]
    return [*ring, ring[0]]


def _inside(ring, x, y):
    xs, ys = np.array([p["x"] for p in ring]), np.array([p["y"] for p in ring])
    x1, y1, x2, y2 = xs[:-1], ys[:-1], xs[1:], ys[1:]
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.array([(((y1 > b) != (y2 > b)) & (a < (x2 - x1) * (b - y1) / (y2 - y1) + x1)).sum() % 2 == 1 for a, b in zip(x, y)])


def test_large_outline_beside_small_ones(spark):
    rings = [_star(20_000, 5, 5, 2.0, 3.0, 1)] + [_star(7, i % 10, i // 10, 0.1, 0.4, i) for i in range(100)]
    polys = spark.createDataFrame([(i, [r]) for i, r in enumerate(rings)], f"pid int, rings {geometry.RINGS}")
    rng = np.random.default_rng(5)
    xy = np.r_[rng.uniform(0, 10, (1500, 2)), rng.integers(0, 40, (200, 2)) * 0.25]  # also on bucket corners
    points = spark.createDataFrame(pd.DataFrame({"id": np.arange(len(xy)), "x": xy[:, 0], "y": xy[:, 1]}))
    got = {(r.id, r.pid) for r in polygons.points_in_polygons(points, polys, "x", "y", "rings", 0.25).select("id", "pid").collect()}
    want = {(int(i), k) for k, r in enumerate(rings) for i in np.flatnonzero(_inside(r, xy[:, 0], xy[:, 1]))}
    assert got == want
    widest = polygons.polygon_cells(polys.where("pid = 0"), "rings", 0.25).agg(F.max(F.size("_e")).alias("m")).first().m
    assert widest < 2000  # no bucket holds the outline


def _clipped(ring, w, s, e, n):
    pts = [(p["x"], p["y"]) for p in ring[:-1]]
    for axis, limit, sign in ((0, w, 1), (0, e, -1), (1, s, 1), (1, n, -1)):
        out = []
        for a, b in zip(pts, pts[1:] + pts[:1]):
            ia, ib = sign * (a[axis] - limit) >= 0, sign * (b[axis] - limit) >= 0
            if ia != ib:
                t = (limit - a[axis]) / (b[axis] - a[axis])
                out.append((a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])))
            if ib:
                out.append(b)
        pts = out
        if not pts:
            return 0.0, None
    x, y = np.array(pts).T
    cross = x * np.roll(y, -1) - np.roll(x, -1) * y
    area = cross.sum() / 2
    if abs(area) < 1e-12:
        return 0.0, None
    return abs(area), (((x + np.roll(x, -1)) * cross).sum() / 6 / area, ((y + np.roll(y, -1)) * cross).sum() / 6 / area)


@pytest.mark.parametrize("shift,turn", [(0.0, 1), (0.13, 1), (0.13, -1)])
def test_clip_cells_not_aligned_with_buckets(spark, shift, turn):
    ring = _star(60, 2.0, 2.0, 0.8, 1.9, 3)[::turn]
    boundary = spark.createDataFrame([([ring],)], f"rings {geometry.RINGS}")
    boxes = [(x * 0.4 + shift, y * 0.3 + shift, x * 0.4 + 0.4 + shift, y * 0.3 + 0.3 + shift) for x in range(-1, 11) for y in range(-1, 14)]
    cells = spark.createDataFrame(boxes, "w double, s double, e double, n double")
    got = {(r.w, r.s): r for r in polygons.clip_cells(cells, boundary, ("w", "s", "e", "n"), "rings", 0.25).collect()}
    for box in boxes:
        area, at = _clipped(ring, *box)
        r = got.get(box[:2])
        assert abs((r.clipped_area if r else 0.0) - area) < 1e-9
        if area > 1e-6:
            assert abs(r.centroid_x - at[0]) < 1e-6 and abs(r.centroid_y - at[1]) < 1e-6


def test_unknown_mesh_values_give_no_number(spark):
    mesh = spark.createDataFrame([(0, 0, 10.0, 1.0), (0, 1, 10.0, 1.0), (1, 0, 10.0, 1.0), (1, 1, None, 1.0)], "mesh_row int, mesh_col int, v double, w2 double")
    cells = spark.createDataFrame([(0.5, 0.5), (3.5, 0.5)], "la double, lo double")
    out = {r.la: (r.v, r.w2) for r in interpolation.mesh_to_grid(mesh, cells, ("la", "lo"), (0.0, 0.0), (1.0, 1.0), ["v", "w2"]).collect()}
    assert out == {0.5: (None, 1.0), 3.5: (None, None)}


def test_equal_boxes_stay_separate(spark):
    ring = [{"x": float(x), "y": float(y)} for x, y in ((0, 0), (3, 0), (3, 3), (0, 3), (0, 0))]
    polys = spark.createDataFrame([([ring],)], f"rings {geometry.RINGS}")
    boxes = spark.createDataFrame([(1.0, 1.0, 2.0, 2.0)] * 2 + [(5.0, 5.0, 6.0, 6.0), (-1.0, -1.0, 9.0, 9.0)], "w double, s double, e double, n double")
    assert polygons.boxes_intersect_polygons(boxes, polys, ("w", "s", "e", "n"), "rings", 0.5, "left_semi").count() == 3


def test_projections(spark):
    df = spark.createDataFrame([(-37.0, 145.0), (-37.8136, 144.9631)], "lat double, lon double")
    vx, vy = grid.vicgrid(F.col("lat"), F.col("lon"))
    mx, my = grid.mga_zone55(F.col("lat"), F.col("lon"))
    rows = df.select(vx.alias("vx"), vy.alias("vy"), mx.alias("mx"), my.alias("my")).collect()
    assert abs(rows[0].vx - 2500000) < 1e-3 and abs(rows[0].vy - 2500000) < 1e-3
    # city centre in zone 55: about 320.7 km east, 5812.9 km north
    assert abs(rows[1].mx - 320704) < 60 and abs(rows[1].my - 5812911) < 60


def test_snap_examples(spark):
    df = spark.createDataFrame([(-37.8147, 145.0892), (-37.8199, 145.0901), (-33.8688, 151.2093), (None, None)], "lat double, lon double")
    got = df.select(grid.snap_round4(F.col("lat")), grid.snap_round4(F.col("lon")), grid.in_bounds(F.col("lat"), F.col("lon"), grid.REGISTRY_BOX)).collect()
    assert tuple(got[0]) == (-37.8, 145.1, True) and tuple(got[1]) == (-37.8, 145.1, True)
    assert not got[2][2] and not got[3][2]


def test_wkt_and_geojson(spark):
    df = spark.createDataFrame([("POLYGON ((0 0, 2 0, 2 1, 0 1, 0 0))", '{"type":"Polygon","coordinates":[[[3,4],[5,4],[5,6],[3,4]]]}'), ("x", "nonsense")], "w string, g string")
    r = df.select(geometry.area(geometry.parse_wkt(F.col("w"))).alias("a"), geometry.ring_min_corner(F.col("g")).alias("c")).collect()
    assert r[0].a == 2.0 and (r[0].c.lon, r[0].c.lat) == (3.0, 4.0) and r[1].c.lon is None


def test_grid_row_col(spark):
    df = spark.createDataFrame([(-1.0, 5.0), (-1.0, 6.0), (2.0, 5.0), (None, 5.0)], "lat double, lon double")
    assert {(r.lat, r.lon): (r.row, r.col) for r in hubs.grid_row_col(df, "lat", "lon").collect()} == {(-1.0, 5.0): (0, 0), (-1.0, 6.0): (0, 1), (2.0, 5.0): (1, 0)}


@pytest.mark.parametrize("edges", [40, 90])
def test_overlay_areas(spark, edges):
    # overlapping outlines, one with a hole, few and many edges; cells not aligned with the buckets
    outlines = {k: [_star(edges, 1.0 + 0.7 * k, 1.2, 0.5, 1.1, k)[:: 1 - 2 * (k % 2)]] for k in range(3)}
    outlines[3] = [_star(8, 2.0, 2.0, 1.5, 1.5, 3), _star(8, 2.0, 2.0, 0.6, 0.6, 3)[::-1]]
    polys = spark.createDataFrame([(k, r) for k, r in outlines.items()], f"pid int, rings {geometry.RINGS}")
    boxes = [(i, x * 0.4 + 0.07, y * 0.3 + 0.11, x * 0.4 + 0.47, y * 0.3 + 0.41) for i, (x, y) in enumerate((x, y) for x in range(-2, 10) for y in range(-2, 13))]
    cells = spark.createDataFrame(boxes, "id int, w double, s double, e double, n double")
    got = {(r.id, r.pid): r for r in polygons.overlay_areas(cells, polys, ("w", "s", "e", "n"), "rings", 0.25).collect()}
    for pid, rings in outlines.items():
        whole = abs(sum(_clipped(r, -9, -9, 9, 9)[0] * (1 if i == 0 else -1) for i, r in enumerate(rings)))
        for i, *box in boxes:
            area = sum(_clipped(r, *box)[0] * (1 if k == 0 else -1) for k, r in enumerate(rings))
            r = got.pop((i, pid), None)
            assert abs((r.overlap_area if r else 0.0) - area) < 1e-9 and (not r or abs(r.overlap_share - area / whole) < 1e-9)
    assert not got


def test_cells_on_bucket_lines_below_zero(spark):
    # -768 * 0.05 is a hair below the bucket line -38.4: the edges that cross it belong to the next bucket
    boxes = [(x, y, x * 0.05, y * 0.05, (x + 1) * 0.05, (y + 1) * 0.05) for x in range(2948, 2955) for y in range(-775, -764)]
    cells = spark.createDataFrame(boxes, "x int, y int, w double, s double, e double, n double")
    ring = [{"x": 147.57 + a, "y": -38.402 + b} for a, b in ((-0.06, 0.0), (0.0, -0.06), (0.06, 0.0), (0.0, 0.06), (-0.06, 0.0))]
    shape = spark.createDataFrame([([ring],)], f"rings {geometry.RINGS}")
    pairs = polygons.overlay_areas(cells, shape, ("w", "s", "e", "n"), "rings", 0.05).collect()
    clipped = polygons.clip_cells(cells, shape, ("w", "s", "e", "n"), "rings", 0.05).collect()
    for got in ({(r.x, r.y): r.overlap_area for r in pairs}, {(r.x, r.y): r.clipped_area for r in clipped}):
        for x, y, *box in boxes:
            assert abs(got.get((x, y), 0.0) - _clipped(ring, *box)[0]) < 1e-10
