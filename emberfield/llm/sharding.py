"""Sharding into equal bytes by histogram sort, with DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from emberfield.llm.blocks import saved

_KEYS = ["group", "id", "row"]


class _Probe:
    """One wanted splitter: the key range it lies in, as far as it is known.

    ``fixed`` are the leading key parts already settled; ``low``..``high`` is the
    range of the next part; ``below`` are the bytes of all rows before that range.
    """

    def __init__(self, target: int, low: int, high: int):
        self.target, self.fixed, self.low, self.high, self.below = target, (), low, high, 0


def _cells(probes: list[_Probe], cells: int) -> list[tuple[tuple, int, int, int]]:
    """Distinct ranges still to be counted, with the width of one histogram cell."""
    ranges = sorted({(p.fixed, p.low, p.high) for p in probes})
    return [(fixed, low, high, (high - low) // cells + 1) for fixed, low, high in ranges]


def _histogram(keyed: DataFrame, ranges: list, slots: int) -> dict:
    """Exact bytes of each cell of each range, its smallest and largest next key part, and its first part's count."""
    schema = T.StructType([T.StructField("r", T.IntegerType())] + [T.StructField(c, T.LongType()) for c in ("f0", "f1", "low", "high", "width", "depth")])
    rows = [(i, *(list(fixed) + [0, 0])[:2], low, high, width, len(fixed)) for i, (fixed, low, high, width) in enumerate(ranges)]
    out = {}
    for depth in sorted({len(fixed) for fixed, *_ in ranges}):
        mine = [r for r in rows if r[-1] == depth]
        part = F.col(_KEYS[depth])
        if depth:  # equi-join on the settled parts; one row per splitter at most
            wanted = F.broadcast(keyed.sparkSession.createDataFrame(mine, schema))
            on = [F.col(_KEYS[d]) == F.col(f"f{d}") for d in range(depth)] + [part >= F.col("low"), part <= F.col("high")]
            found = keyed.join(wanted, reduce(lambda a, b: a & b, on))
        else:
            bounds = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("r", "low", "high", "width"), (r[0], r[3], r[4], r[5]), strict=True)]) for r in mine])
            found = keyed.withColumn("at", F.get(F.filter(bounds, lambda b: (part >= b["low"]) & (part <= b["high"])), F.lit(0))).where("at is not null").select("*", "at.*")
        cell = F.expr(f"({_KEYS[depth]} - low) div width")
        counted = found.groupBy("r", cell.alias("cell")).agg(F.sum("size").alias("bytes"), F.min(part).alias("first"), F.max(part).alias("last"))
        for x in counted.collect():  # at most ``cells`` rows for each range
            out.setdefault(x["r"], []).append((x["cell"], x["bytes"], x["first"], x["last"]))
    return {ranges[i]: sorted(v) for i, v in out.items()}


def _splitters(keyed: DataFrame, targets: list[int], group_bytes: int, cells: int) -> list[tuple]:
    """For each target, the smallest key (group, id, row) before which at least so many bytes lie.

    A group of at most ``group_bytes`` is not cut: the splitter moves to its end.
    Each round counts the bytes of ``cells`` candidate cells for every splitter still open,
    over all rows, and goes on inside the one cell that holds it.
    """
    low, high = keyed.agg(F.min("group"), F.max("group")).first()
    done: dict[int, tuple] = {}
    still = [_Probe(t, low, high) for t in targets]
    while still:
        ranges = _cells(still, cells)
        lookup = {r[:3]: r for r in ranges}
        counts = _histogram(keyed, ranges, cells)
        following = []
        for p in still:
            below = p.below
            for _, size, first, last in counts[lookup[(p.fixed, p.low, p.high)]]:
                if below >= p.target:  # the splitter is exactly where this cell starts
                    done[p.target] = (*p.fixed, first)
                    break
                if below + size > p.target or (below + size == p.target and first != last):
                    if first != last:
                        p.low, p.high, p.below = first, last, below
                        following.append(p)
                        break
                    depth = len(p.fixed)
                    if depth == 2 or (depth == 0 and size <= group_bytes):
                        done[p.target] = (*p.fixed, first + 1)  # not to be cut
                        break
                    p.fixed, p.below, p.low, p.high = (*p.fixed, first), below, -(1 << 62), (1 << 62)
                    following.append(p)
                    break
                below += size
            else:
                done[p.target] = (*p.fixed, last + 1)
        still = following
    return [done[t] for t in targets]


def _at_or_after(keys: list[tuple]) -> Column:
    """Number of splitters at or before the row's key; a splitter may name leading parts only."""
    low = -(1 << 63)
    full = [F.struct(*[F.lit(v).cast("long").alias(n) for n, v in zip(_KEYS, (*k, *[low] * (3 - len(k))), strict=True)]) for k in keys]
    if not full:
        return F.lit(0)
    return F.size(F.filter(F.array(*full), lambda s: s <= F.struct(*_KEYS)))


def shard_by_bytes(
    rows: DataFrame, group: Column, row_id: Column, size: Column, shards: int = 24, tolerance: float = 0.02, rows_per_task: int = 20_000, cells: int = 1024
) -> DataFrame:
    """Deal rows to ``shards`` contiguous key ranges of nearly equal bytes, numbered gapless inside.

    The key is (``group``, ``row_id``, a number for repeated rows), all long: the
    order keeps equal groups together. Shard k starts at the first key before
    which k / shards of all bytes lie. A group up to ``tolerance`` of a shard's mean is never cut:
    it goes where it starts. A larger one is cut between rows, so a shard misses its share by one such group or row at most.

    Histogram sort: each round counts exact bytes between candidate keys over the
    whole table, one small row per cell reaching the driver, and refines only the cells
    that hold splitters. Besides the shards' splitters it finds finer ones, so that the one exchange deals
    about ``rows_per_task`` rows to a task, whatever the number of shards.

    Returns the rows with ``size``, ``shard`` and ``slot``. Null groups or ids sort
    first. No rows give no rows. Input columns with the names used here are replaced.
    """
    names = [c for c in rows.columns if c not in (*_KEYS, "size", "shard", "slot", "fine")]
    least = F.lit(-(1 << 62))
    keyed = rows.select(
        *names, F.coalesce(group.cast("long"), least).alias("group"), F.coalesce(row_id.cast("long"), least).alias("id"), size.cast("long").alias("size")
    ).withColumn("row", F.monotonically_increasing_id())
    keyed = saved(keyed, "keyed")
    total, count = keyed.agg(F.sum("size"), F.count(F.lit(1))).first()
    if not count:
        return keyed.select(*names, "size", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    per_shard = max(1, -(-count // (shards * rows_per_task)))
    n = shards * per_shard
    targets = [-(-total * k // n) for k in range(1, n)]
    by_target = dict(zip(sorted(set(targets)), _splitters(keyed, sorted(set(targets)), int(tolerance * total / shards), cells), strict=True))
    keys = [by_target[t] for t in targets]
    fine = saved(keyed.withColumn("fine", _at_or_after(keys)), "fine")
    counts = dict(fine.groupBy("fine").count().collect())
    offsets, at = [], 0
    for f in range(n):
        at = 0 if f % per_shard == 0 else at
        offsets.append(at)
        at += counts.get(f, 0)
    inside = F.row_number().over(Window.partitionBy("fine").orderBy(*_KEYS)) - 1
    offset = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), F.col("fine") + 1)
    return fine.withColumn("slot", offset + inside).select(*names, "size", F.floor(F.col("fine") / per_shard).cast("int").alias("shard"), "slot")
