"""Spreading observations over a grid: nearest, inverse distance, mesh bilinear and bicubic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberfield.operators import nearest


def nearest_to_grid(
    obs: DataFrame, cells: DataFrame, obs_latlon, cell_latlon, values: list[str], obs_id: str, by: list[str] | None = None
) -> DataFrame:
    """Every numeric column of the nearest observation for each grid cell (per ``by``, e.g. time)."""
    by = list(by or [])
    found = nearest.nearest_join(cells, obs, cell_latlon, obs_latlon, obs_id, by=by, out=("_oid", "distance"))
    source = obs.select(*by, F.col(obs_id).alias("_oid"), *values)
    near = found.drop("rank").join(source, [*by, "_oid"]).drop("_oid")
    return cells.join(near, [*by, *cell_latlon], "left")


def idw_to_grid(
    obs: DataFrame, cells: DataFrame, obs_latlon, cell_latlon, values: list[str], obs_id: str, k: int = 4,
    power: float = 2.0, by: list[str] | None = None,
) -> DataFrame:
    """Inverse-distance mean of the ``k`` nearest observations; an exact hit takes its value."""
    by = list(by or [])
    found = nearest.nearest_join(cells, obs, cell_latlon, obs_latlon, obs_id, by=by, k=k, out=("_oid", "_d"))
    rows = found.join(obs.select(*by, F.col(obs_id).alias("_oid"), *values), [*by, "_oid"])
    w = F.when(F.col("_d") > 0, F.pow("_d", F.lit(-power)))
    aggs = []
    for v in values:
        known = F.col(v).isNotNull()
        exact = F.avg(F.when(F.col("_d") == 0, F.col(v)))
        mean = F.sum(F.when(known, w * F.col(v))) / F.sum(F.when(known, w))
        aggs.append(F.coalesce(exact, mean).alias(v))
    spread = rows.groupBy(*by, *cell_latlon).agg(*aggs)
    return cells.join(spread, [*by, *cell_latlon], "left")


def _bilinear(t: Column, i: int) -> Column:
    return (1 - t) if i == 0 else t


def _cubic(t: Column, i: int) -> Column:
    """Catmull-Rom weights of the four mesh lines around a position."""
    t2, t3 = t * t, t * t * t
    return {
        -1: -0.5 * t3 + t2 - 0.5 * t, 0: 1.5 * t3 - 2.5 * t2 + 1.0,
        1: -1.5 * t3 + 2.0 * t2 + 0.5 * t, 2: 0.5 * t3 - 0.5 * t2,
    }[i]


def mesh_to_grid(
    mesh: DataFrame, cells: DataFrame, cell_latlon: tuple[str, str], origin: tuple[float, float], step: tuple[float, float],
    values: list[str], kind: str = "bilinear", by: list[str] | None = None,
) -> DataFrame:
    """Smooth fill from a regular mesh (columns mesh_row, mesh_col) by equal-key joins.

    A cell without all its mesh neighbours, or with a NULL among their values, gets NULL; callers fall back to the nearest.
    """
    if kind not in ("bilinear", "bicubic"):
        raise ValueError("kind must be 'bilinear' or 'bicubic'")
    by = list(by or [])
    offsets = [0, 1] if kind == "bilinear" else [-1, 0, 1, 2]
    weight = _bilinear if kind == "bilinear" else _cubic
    lat, lon = cell_latlon
    pos = cells.select(*by, lat, lon).distinct().withColumns({
        "_fy": (F.col(lat) - F.lit(origin[0])) / F.lit(step[0]), "_fx": (F.col(lon) - F.lit(origin[1])) / F.lit(step[1]),
    }).withColumns({"_r": F.floor("_fy"), "_c": F.floor("_fx")})
    ty, tx = F.col("_fy") - F.col("_r"), F.col("_fx") - F.col("_c")
    around = F.array(*[
        F.struct(
            (F.col("_r") + i).alias("mesh_row"), (F.col("_c") + j).alias("mesh_col"),
            (weight(ty, i) * weight(tx, j)).alias("w"),
        )
        for i in offsets for j in offsets
    ])
    need = pos.select(*by, lat, lon, F.explode(around).alias("n")).select(*by, lat, lon, "n.*").where("w != 0")
    all_of = F.count(F.lit(1))
    full = need.join(mesh.select(*by, "mesh_row", "mesh_col", *values), [*by, "mesh_row", "mesh_col"], "left").groupBy(*by, lat, lon).agg(
        *[F.when(F.count(v) == all_of, F.sum(F.col("w") * F.col(v))).alias(v) for v in values]
    )
    return cells.join(full, [*by, lat, lon], "left")


def with_fallback(smooth: DataFrame, near: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Fill what the smooth method left NULL from the nearest method."""
    fb = near.select(*keys, *[F.col(v).alias(f"_n_{v}") for v in values])
    return smooth.join(fb, keys, "left").withColumns({v: F.coalesce(v, f"_n_{v}") for v in values}).drop(
        *[f"_n_{v}" for v in values]
    )
