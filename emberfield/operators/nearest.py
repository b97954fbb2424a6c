"""Exact nearest-neighbour joins by descending a tree of occupied grid cells.

Targets are first reduced to distinct coordinates, then summarised into levels of
grid cells, each with the tight bounds and the number of targets below it. Every
query point walks down from one root cell: a cell is dropped only when its lower
distance bound exceeds the bound already guaranteed by another cell, so the result
is the true nearest target while each point carries only a handful of candidate
cells. Each cell ends where it holds few targets; only crowded ones are divided
further, as deep as it takes until their distinct coordinates separate. So nothing
pairs a whole group with a whole group, and a crowded place costs depth only there.

All joins are equi-joins on a cell key. The tree is written once, its levels counted,
and only levels counted to be small are broadcast. While levels are broadcast the walk
stays partitioned by point, so it shuffles once.

Where the tree is too large for that, a walk would shuffle every point with its candidate
cells once per level. Instead a point meets the targets of its own leaf, which bounds its
distance, and then those of the few other cells within that distance: two shuffles, however
deep the tree is. Only points that this leaves open (no target in their leaf's place, or a
more crowded cell within their distance) walk down, over shuffled levels.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emberfield.functions import grid
from emberfield.session import dealt, durable, sized_broadcast

_SIZES = [16.0 / 4.0**level for level in range(26)]  # the last is about the spacing of doubles at these coordinates
_FIRST_LEVELS = 9  # built for all targets; below, only crowded cells are divided
_FIRST_LEVELS_LARGE = 5  # the same for targets beyond _BROADCAST_ROWS: most of them lie in no crowded cell below
_LEAF_TARGETS = 64
_ROOT_CELLS = 32
_BROADCAST_ROWS = 200_000
_SLACK = 1e-9
_REACH_CELLS = 8  # along each side: more are not listed for a point, it walks
_POINTS_PER_TASK = 1 << 20  # bytes of input files: each point starts with all root cells


@dataclass(frozen=True)
class Metric:
    """How to measure a point against a target and against the bounds of a cell.

    ``axes`` names the target coordinates kept as cell bounds (expressions on the
    columns lat/lon); ``low``/``high`` bound the rank of anything inside a cell and
    ``exact`` ranks one target. All three return the same comparable type.
    """

    axes: dict[str, Callable[[Column, Column], Column]]
    low: Callable[[Column, Column], Column]
    high: Callable[[Column, Column], Column]
    exact: Callable[[Column, Column], Column]
    window: Callable[[Column, Column], tuple[Column, Column]] | None = None  # degrees of lat and lon that hold all within a distance


def _gap(p: Column, lo: Column, hi: Column) -> Column:
    return F.greatest(lo - p, p - hi, F.lit(0.0))


def _reach(p: Column, lo: Column, hi: Column) -> Column:
    return F.greatest(F.abs(p - lo), F.abs(p - hi))


def _shrink(bound):
    """Lower bounds give way to rounding, so that ties survive until the ids are compared."""
    return lambda p, c: bound(p, c) * F.lit(1 - _SLACK) - F.lit(_SLACK)


def _widen(bound):
    return lambda p, c: bound(p, c) * F.lit(1 + _SLACK) + F.lit(_SLACK)


_LATLON = {"lat": lambda lat, lon: lat, "lon": lambda lat, lon: lon}


def _flat(scale_lat: Callable[[Column], Column], scale_lon: Callable[[Column], Column], exact) -> Metric:
    def window(p: Column, d: Column) -> tuple[Column, Column]:
        return d / scale_lat(p), F.try_divide(d, scale_lon(p))

    def bound(side):
        def f(p: Column, c: Column) -> Column:
            dy = side(p["lat"], c["lat_lo"], c["lat_hi"]) * scale_lat(p)
            dx = side(p["lon"], c["lon_lo"], c["lon_hi"]) * scale_lon(p)
            return F.sqrt(dy * dy + dx * dx)
        return f

    return Metric(_LATLON, _shrink(bound(_gap)), _widen(bound(_reach)), exact, window)


EUCLID_DEGREES = _flat(
    lambda p: F.lit(1.0), lambda p: F.lit(1.0),
    lambda p, t: grid.euclid_degrees(p["lat"], p["lon"], t["lat"], t["lon"]),
)

EQUIRECT_KM = _flat(
    lambda p: F.lit(grid.DEGREE_KM), lambda p: F.lit(grid.DEGREE_KM) * F.cos(F.radians(p["lat"])),
    lambda p, t: grid.equirect_km(p["lat"], p["lon"], t["lat"], t["lon"]),
)

_SPHERE = {
    "ux": lambda lat, lon: F.cos(F.radians(lat)) * F.cos(F.radians(lon)),
    "uy": lambda lat, lon: F.cos(F.radians(lat)) * F.sin(F.radians(lon)),
    "uz": lambda lat, lon: F.sin(F.radians(lat)),
}


def haversine_metric(radius: float) -> Metric:
    """Great-circle distance; cells are bounded by the chord to their box in space."""
    def bound(side):
        def f(p: Column, c: Column) -> Column:
            parts = [side(fn(p["lat"], p["lon"]), c[f"{a}_lo"], c[f"{a}_hi"]) for a, fn in _SPHERE.items()]
            chord = F.sqrt(sum((x * x for x in parts[1:]), parts[0] * parts[0]))
            return F.asin(F.least(chord / 2, F.lit(1.0))) * F.lit(2 * radius)
        return f

    return Metric(
        _SPHERE, _shrink(bound(_gap)), _widen(bound(_reach)),
        lambda p, t: grid.haversine_km(p["lat"], p["lon"], t["lat"], t["lon"], radius),
    )


HAVERSINE_KM = haversine_metric(grid.EARTH_KM)
HAVERSINE_M = haversine_metric(6371000.0)


_DEEPEST = len(_SIZES) - 1


def _key(prefix: str, level: int) -> list[Column]:
    size = _SIZES[level]
    return [
        F.floor(F.col("lat") / F.lit(size)).cast("bigint").alias(f"{prefix}y"),
        F.floor(F.col("lon") / F.lit(size)).cast("bigint").alias(f"{prefix}x"),
    ]


def _at_levels(levels: range) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(i).alias("level"), *_key("k", i)) for i in levels])).alias("at")


def _cells(targets: DataFrame, by: list[str], metric: Metric, levels: range) -> DataFrame:
    """Occupied cells of some levels with tight bounds and target counts, written once."""
    axes = {a: fn(F.col("lat"), F.col("lon")) for a, fn in metric.axes.items()}
    rows = targets.select(*by, _at_levels(levels), *[v.alias(f"_{a}") for a, v in axes.items()])
    names, bounds = [], []
    for a in axes:
        names += [f"{a}_lo", f"{a}_hi"]
        bounds += [F.min(f"_{a}").alias(f"{a}_lo"), F.max(f"_{a}").alias(f"{a}_hi")]
    cells = rows.groupBy(*by, "at.level", "at.ky", "at.kx").agg(F.count(F.lit(1)).alias("n"), *bounds)
    return durable(cells.select(*by, "level", "ky", "kx", "n", F.struct(*names).alias("cell")))


@dataclass(frozen=True)
class _Tree:
    """Root cells and, below them, the cells of crowded parents only; row counts by level."""

    roots: DataFrame
    below: DataFrame
    start: int
    deepest: int
    cells: dict[int, int]
    leaves: dict[int, int]
    targets: int
    first: int

    def step(self, by: list[str], level: int) -> tuple[DataFrame, int]:
        """What each cell above ``level`` becomes there: its parts, or itself if it is not crowded."""
        own = [F.col("level").alias("clv"), F.col("ky").alias("cy"), F.col("kx").alias("cx")]
        rest = ["level", "ky", "kx", "n", "leaf", "cell"]
        parent = [(F.col("level") - 1).alias("clv"), F.floor(F.col("ky") / 4).alias("cy"), F.floor(F.col("kx") / 4).alias("cx")]
        parts = self.below.where(F.col("level") == level).select(*by, *parent, *rest)
        kept = self.roots.unionByName(self.below).where((F.col("level") < level) & F.col("leaf")).select(*by, *own, *rest)
        return parts.unionByName(kept), self.cells.get(level, 0) + sum(n for lv, n in self.leaves.items() if lv < level)


    def large(self) -> bool:
        """Whether levels or targets can't be broadcast."""
        return max(self.targets, *self.cells.values(), 0) > _BROADCAST_ROWS

    def leaf_levels(self, by: list[str]) -> DataFrame:
        """``levels`` that have leaves, for each group."""
        return self.roots.unionByName(self.below).where("leaf").groupBy(*by).agg(F.collect_set("level").alias("levels"))

    def contents(self, targets: DataFrame, by: list[str]) -> DataFrame:
        """Targets with the leaf that holds each: ``clv``, ``cy``, ``cx``, place ``t`` and ``id``."""
        whole = self.roots.unionByName(self.below)
        leaves = whole.where("leaf").select(*by, F.col("level").alias("clv"), F.col("ky").alias("cy"), F.col("kx").alias("cx"))
        placed = _at_own_levels(targets, self, by, "lat", "lon").select(*by, "clv", "cy", "cx", F.struct("lat", "lon").alias("t"), "id")
        return placed.join(_sized(leaves, sum(self.leaves.values())), [*by, "clv", "cy", "cx"], "left_semi")


def _side(level: str) -> Column:
    return F.get(F.array(*[F.lit(x) for x in _SIZES]), F.col(level))


def _at_own_levels(rows: DataFrame, tree: _Tree, by: list[str], lat: str, lon: str) -> DataFrame:
    """Rows with their cells ``clv``, ``cy``, ``cx`` at all levels where their group has leaves, which are in ``levels``."""
    if by:
        known = rows.join(sized_broadcast(tree.leaf_levels(by)), by)
    else:
        known = rows.withColumn("levels", F.array(*[F.lit(lv) for lv, n in sorted(tree.leaves.items()) if n]).cast("array<int>"))
    at = known.select("*", F.explode("levels").alias("clv"))
    return at.withColumns({c: F.floor(F.col(v) / _side("clv")).cast("bigint") for c, v in (("cy", lat), ("cx", lon))})


def _tree(targets: DataFrame, by: list[str], metric: Metric) -> _Tree:
    first = _FIRST_LEVELS if targets.count() <= _BROADCAST_ROWS else _FIRST_LEVELS_LARGE
    whole = _cells(targets, by, metric, range(first))
    last, rows, newest = first - 1, targets, whole
    while last < _DEEPEST:
        crowded = newest.where((F.col("level") == last) & (F.col("n") > _LEAF_TARGETS)).select(*by, "ky", "kx")
        if not crowded.limit(1).count():
            break
        rows = durable(rows.select("*", *_key("k", last)).join(crowded, [*by, "ky", "kx"], "left_semi").drop("ky", "kx"))
        levels = range(last + 1, min(last + 5, _DEEPEST + 1))
        newest = _cells(rows, by, metric, levels)
        whole, last = whole.unionByName(newest), levels[-1]
    per_level = {r["level"]: r["cells"] for r in whole.groupBy("level").agg(F.count(F.lit(1)).alias("cells")).collect()}
    start = max((lv for lv, n in per_level.items() if n <= _ROOT_CELLS and lv < first), default=0)  # levels that hold all targets
    marked = whole.withColumn("leaf", (F.col("n") <= _LEAF_TARGETS) | (F.col("level") == _DEEPEST))
    up = [*by, "level", "py", "px"]
    above = whole.where(F.col("n") > _LEAF_TARGETS).select(*by, (F.col("level") + 1).alias("level"), F.col("ky").alias("py"), F.col("kx").alias("px"))
    below = marked.where(F.col("level") > start).withColumns({"py": F.floor(F.col("ky") / 4), "px": F.floor(F.col("kx") / 4)})
    below = durable(below.join(above, up, "left_semi").drop("py", "px"))
    roots = marked.where(F.col("level") == start)
    counts = roots.unionByName(below).groupBy("level").agg(F.count(F.lit(1)).alias("c"), F.count_if("leaf").alias("l"), F.sum("n").alias("n")).collect()
    cells, leaves = {r["level"]: r["c"] for r in counts}, {r["level"]: r["l"] for r in counts}
    total = sum(r["n"] for r in counts if r["level"] == start)
    return _Tree(roots, below, start, max(cells, default=start), cells, leaves, total, first)


def _sized(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a side whose exact row count is known to be small; else let Spark shuffle it."""
    return F.broadcast(df) if rows <= _BROADCAST_ROWS else df


def _walk(pts: DataFrame, leaves: DataFrame, tree: _Tree, by: list[str], metric: Metric, k: int) -> DataFrame:
    """Every place walks down from the roots, level by level, to the leaves: the ``k`` nearest as ``m`` with their ``rank``."""
    here = [*by, "plat", "plon"]
    p = {"lat": F.col("plat"), "lon": F.col("plon")}
    same_point = Window.partitionBy(*here)
    at = ["clv", "cy", "cx"]

    def pruned(walk: DataFrame) -> DataFrame:
        """Cells that can still hold one of the k nearest; ``busy`` points have cells to divide among them."""
        joined = walk.select(
            *here, F.col("level").alias("clv"), F.col("ky").alias("cy"), F.col("kx").alias("cx"), "n", "leaf",
            metric.low(p, F.col("cell")).alias("low"),
            metric.high(p, F.col("cell")).alias("high"),
        )
        if k == 1:
            limit = F.min("high").over(same_point)
        else:
            # bound of the k-th nearest: cells sorted by upper bound until k targets are covered
            nearer = same_point.orderBy("high", *at).rowsBetween(Window.unboundedPreceding, 0)
            joined = joined.withColumn("_cum", F.sum("n").over(nearer))
            kth = F.min(F.when(F.col("_cum") >= k, F.col("high"))).over(same_point)
            limit = F.coalesce(kth, F.max("high").over(same_point))
        return joined.withColumn("_limit", limit).where(F.col("low") <= F.col("_limit")).select(*here, *at, "leaf")

    roots = tree.roots.select(*by, "level", "ky", "kx", "n", "leaf", "cell")
    if by:
        walk = pruned(pts.join(_sized(roots, tree.cells.get(tree.start, 0)), by))
    else:
        # a few dozen cells at most: every point starts from the same short array
        first = roots.agg(F.collect_list(F.struct(*roots.columns))).scalar()
        walk = pruned(pts.select("*", F.explode(first).alias("c")).select(*here, "c.*"))
    done = None
    for level in range(tree.start + 1, tree.deepest + 1):
        step, rows = tree.step(by, level)
        walk = pruned(walk.drop("leaf").join(_sized(step, rows), [*by, *at]))
        if level >= tree.first - 1 and level < tree.deepest and (level - tree.first + 1) % 4 == 0:
            # points with nothing left to divide stay here, whatever the depth elsewhere
            walk = durable(walk.withColumn("busy", F.max(~F.col("leaf")).over(same_point)))
            stay = walk.where(~F.col("busy")).drop("busy")
            done = stay if done is None else done.unionByName(stay)
            walk = walk.where("busy").drop("busy")
    walk = walk if done is None else walk.unionByName(done)
    ranked = walk.join(_sized(leaves, tree.targets), [*by, *at]).select(
        *here, F.struct(metric.exact(p, F.col("t")).alias("d"), F.col("id")).alias("m")
    )
    if k == 1:
        return ranked.groupBy(*here).agg(F.min("m").alias("m")).withColumn("rank", F.lit(1))
    return ranked.withColumn("rank", F.row_number().over(same_point.orderBy("m"))).where(F.col("rank") <= k)


def _direct(pts: DataFrame, leaves: DataFrame, tree: _Tree, by: list[str], metric: Metric) -> tuple[DataFrame, DataFrame]:
    """Nearest target ``m`` of the places that their own leaf and the cells within its distance settle, and the other places.

    A place in a leaf lists the cells within its distance at the leaf's level and at those above. A target there is in a
    leaf of these levels or below a divided cell at the leaf's own; a place with such a cell in reach is left open.
    """
    here, at = [*by, "plat", "plon"], ["clv", "cy", "cx"]
    p = {"lat": F.col("plat"), "lon": F.col("plon")}
    ranked = F.struct(metric.exact(p, F.col("t")).alias("d"), F.col("id"))
    own = _at_own_levels(pts, tree, by, "plat", "plon").join(leaves, [*by, *at])
    own = durable(own.select(*here, "levels", *at, ranked.alias("m")).groupBy(*here, "levels", *at).agg(F.min("m").alias("m")))

    wy, wx = metric.window(p, F.col("m.d") * F.lit(1 + _SLACK) + F.lit(_SLACK))
    reach = own.select("*", wy.alias("wy"), wx.alias("wx"))
    ends = {f"{c}{i}": (F.col(v) + sign * F.col(w)) for c, v, w in (("y", "plat", "wy"), ("x", "plon", "wx")) for i, sign in ((0, -1), (1, 1))}
    spans = {c: F.floor(v / _side("clv")).cast("bigint") for c, v in ends.items()}  # at its own level, where they are the longest
    listed = F.col("y1").between(F.col("y0"), F.col("y0") + _REACH_CELLS) & F.col("x1").between(F.col("x0"), F.col("x0") + _REACH_CELLS)
    reach = reach.withColumns(spans).withColumn("listed", F.coalesce(listed, F.lit(False)))
    others = reach.where("listed").select(
        *here, F.col("m.d").alias("d"), F.struct(*at).alias("own"), *[v.alias(f"_{c}") for c, v in ends.items()],
        F.explode(F.filter("levels", lambda lv: lv <= F.col("clv"))).alias("clv"))
    for c in "yx":
        span = F.sequence(*[F.floor(F.col(f"_{c}{i}") / _side("clv")).cast("bigint") for i in (0, 1)])
        others = others.select("*", F.explode(span).alias(f"c{c}"))
    others = others.where(F.struct(*at) != F.col("own")).select(*here, "d", *at, (F.col("clv") == F.col("own.clv")).alias("deepest"))

    whole = tree.roots.unionByName(tree.below)
    divided = whole.where(~F.col("leaf")).select(*by, F.col("level").alias("clv"), F.col("ky").alias("cy"), F.col("kx").alias("cx"), "cell")
    blank = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    there = leaves.select(*by, *at, "t", "id", blank(divided, "cell")).unionByName(divided.select(*by, *at, blank(leaves, "t"), blank(leaves, "id"), "cell"))
    met = others.join(there, [*by, *at])
    open_ = F.col("t").isNull() & F.col("deepest") & (metric.low(p, F.col("cell")) <= F.col("d"))
    second = met.select(*here, F.when(F.col("t").isNotNull(), ranked).alias("m"), open_.alias("open"), "d").where(F.col("open") | (F.col("m.d") <= F.col("d")))

    no_target = F.lit(None).cast(own.schema["m"].dataType).alias("m")
    parts = pts.select(*here, no_target, F.lit(False).alias("open"))
    parts = parts.unionByName(own.select(*here, "m", F.lit(False).alias("open")))
    parts = parts.unionByName(reach.where("not listed").select(*here, no_target, F.lit(True).alias("open")))
    parts = parts.unionByName(second.select(*here, "m", "open"))
    found = durable(dealt(parts, *here).groupBy(*here).agg(F.min("m").alias("m"), F.max("open").alias("open")))
    settled = F.col("m").isNotNull() & ~F.col("open")
    return found.where(settled).select(*here, "m", F.lit(1).alias("rank")), found.where(~settled).select(*here)


def nearest_join(
    points: DataFrame,
    targets: DataFrame,
    point_latlon: tuple[str, str],
    target_latlon: tuple[str, str],
    target_id: str,
    metric: Metric = EUCLID_DEGREES,
    by: list[str] | None = None,
    k: int = 1,
    out: tuple[str, str] = ("target_id", "distance"),
) -> DataFrame:
    """The ``k`` nearest targets of every distinct point coordinate.

    Returns one row per (``by`` values, point coordinates, rank): the columns of
    ``by``, ``point_latlon``, ``rank`` (1 = nearest; ties by lowest id) and ``out``.
    ``by`` columns must be equal on both sides, e.g. the calendar day.
    """
    by = list(by or [])
    here = [*by, "plat", "plon"]
    places = points.select(*by, F.col(point_latlon[0]).alias("plat"), F.col(point_latlon[1]).alias("plon")).dropna()
    raw = targets.select(
        *by, F.col(target_latlon[0]).alias("lat"), F.col(target_latlon[1]).alias("lon"), F.col(target_id).alias("id")
    ).dropna()
    if k == 1:
        tgt = dealt(raw, *by, "lat", "lon").groupBy(*by, "lat", "lon").agg(F.min("id").alias("id"))
    else:
        # co-located targets beyond the k lowest ids can never be among the k nearest
        first_k = Window.partitionBy(*by, "lat", "lon").orderBy("id")
        tgt = raw.withColumn("_r", F.row_number().over(first_k)).where(F.col("_r") <= k).drop("_r")

    tgt = durable(tgt)
    tree = _tree(tgt, by, metric)
    leaves = tree.contents(tgt, by)
    if k == 1 and metric.window and tree.large():
        pts = dealt(places, *here).distinct()
        if by:  # a place whose group has no target finds none
            pts = pts.join(sized_broadcast(tree.leaf_levels(by).select(*by)), by, "left_semi")
        leaves = durable(leaves)
        best, rest = _direct(pts, leaves, tree, by, metric)
        if not rest.isEmpty():
            best = best.unionByName(_walk(dealt(rest, *here, per_task=_POINTS_PER_TASK), leaves, tree, by, metric, k))
    else:
        best = _walk(dealt(places, *here, per_task=_POINTS_PER_TASK).distinct(), leaves, tree, by, metric, k)
    return best.select(
        *by, F.col("plat").alias(point_latlon[0]), F.col("plon").alias(point_latlon[1]), "rank",
        F.col("m.id").alias(out[0]), F.col("m.d").alias(out[1]),
    )


def attach_nearest(points: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Left-join a ``nearest_join`` result back onto the full rows (nulls never match)."""
    return points.join(found.drop("rank"), keys, "left")


# Half-widths in degrees of the search windows, tried in this order.
SEARCH_WINDOWS = [0.02, 0.05, 0.1, 0.25, 0.5, 1.0]


def _tier(reach: Column) -> Column:
    tier = F.when(reach <= SEARCH_WINDOWS[0], 0)
    for i, w in enumerate(SEARCH_WINDOWS[1:], start=1):
        tier = tier.when(reach <= w, i)
    return tier.otherwise(len(SEARCH_WINDOWS))


def _tiered(tier_side, km: Callable[[Column, Column], Column]):
    def f(p: Column, c: Column) -> Column:
        reach = F.greatest(
            tier_side(p["lat"], c["lat_lo"], c["lat_hi"]), tier_side(p["lon"], c["lon_lo"], c["lon_hi"])
        )
        return F.struct(_tier(reach).alias("tier"), km(p, c).alias("km"))
    return f


def _tier_exact(p: Column, t: Column) -> Column:
    # compared the way the window query is written: target between point - w and point + w
    def inside(w: float) -> Column:
        return t["lat"].between(p["lat"] - F.lit(w), p["lat"] + F.lit(w)) & t["lon"].between(
            p["lon"] - F.lit(w), p["lon"] + F.lit(w)
        )

    tier = F.when(inside(SEARCH_WINDOWS[0]), 0)
    for i, w in enumerate(SEARCH_WINDOWS[1:], start=1):
        tier = tier.when(inside(w), i)
    return F.struct(
        tier.otherwise(len(SEARCH_WINDOWS)).alias("tier"), EQUIRECT_KM.exact(p, t).alias("km")
    )


# bounds are widened a hair so that a target on a window edge is never pruned
WINDOWED_KM = Metric(
    _LATLON,
    _tiered(lambda p, lo, hi: _gap(p, lo, hi) - F.lit(1e-12), EQUIRECT_KM.low),
    _tiered(lambda p, lo, hi: _reach(p, lo, hi) + F.lit(1e-12), EQUIRECT_KM.high),
    _tier_exact,
)


def nearest_registry_windowed(
    points: DataFrame,
    registry: DataFrame,
    point_latlon: tuple[str, str],
    max_km: float = 20.0,
    box: grid.Box = grid.REGISTRY_BOX,
) -> DataFrame:
    """Nearest registry row inside the first non-empty square window, NULL beyond ``max_km``.

    The first window can hold a row that is farther than the global nearest; that is
    the rule. Returns the distinct in-bounds coordinates with ``location_id``, ``km``.
    """
    lat, lon = point_latlon
    inside = points.where(grid.in_bounds(F.col(lat), F.col(lon), box))
    found = nearest_join(
        inside, registry, point_latlon, ("grid_latitude", "grid_longitude"), "location_id",
        metric=WINDOWED_KM, out=("location_id", "m"),
    )
    near = F.col("m.km") <= F.lit(max_km)
    return found.select(
        lat, lon, F.when(near, F.col("location_id")).alias("location_id"), F.when(near, F.col("m.km")).alias("km")
    )
