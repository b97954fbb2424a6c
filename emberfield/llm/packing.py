"""Packing of documents into sequences of a fixed number of tokens."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfield.llm.blocks import saved, slices
from emberfield.llm.tokens import ByteBpe


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 1024, end_id: int = 2, tokenizer: str = "byte_bpe_50k") -> DataFrame:
    """(id, piece, start, length, ids): token ids of each text plus ``end_id``, cut to at most ``length``.

    Only the first piece of a text may be shorter than ``length``; a null or
    empty text is the end id alone. ``ids`` are little-endian unsigned 32-bit numbers.
    Repeated rows give repeated pieces; other columns are ignored.
    """
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(tokenizer)
        for b in slices(batches):
            out: list[tuple] = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = bpe.ids(text) + end
                n = len(ids) // 4
                stops = list(range((n - 1) % length + 1, n + 1, length))
                for k, (start, stop) in enumerate(zip([0, *stops], stops, strict=False)):
                    out.append((doc, k, start, stop - start, ids[4 * start : 4 * stop]))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            columns = zip(*out, strict=True) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["id", "piece", "start", "length", "ids"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(cut, "id long, piece int, start long, length long, ids binary")


class _Bins:
    """Open bins by room left; the smallest room that suffices is one bit search away."""

    def __init__(self, capacity: int):
        self.rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0

    def take(self, size: int) -> tuple[int, int] | None:
        above = self.mask >> size
        if not above:
            return None
        room = size + (above & -above).bit_length() - 1
        found = self.rooms[room].pop()
        if not self.rooms[room]:
            self.mask ^= 1 << room
        return found, room

    def put(self, number: int, room: int) -> None:
        if room:
            self.rooms[room].append(number)
            self.mask |= 1 << room


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers: the largest item first, into the fullest bin it fits."""
    bins: list[list[int]] = []
    open_bins = _Bins(capacity)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        found = open_bins.take(size)
        if found is None:
            bins.append([i])
            open_bins.put(len(bins) - 1, capacity - size)
        else:
            bins[found[0]].append(i)
            open_bins.put(found[0], found[1] - size)
    return bins


def swap_search(bins: list[list[int]], sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Empty underfull bins by exchanges that raise the sum of squared fills.

    The emptiest bin gives: an item moves to a fuller bin, or one or two of its items
    are exchanged for one smaller item there (or one for two), so that the fuller bin gains. Each step takes the
    largest gain. Rounds go on while they empty bins and more bins are left than the tokens need.
    """
    fill = np.array([int(sizes[b].sum()) for b in bins], np.int64)
    needed = -(-int(fill.sum()) // capacity)
    under = [i for i in range(len(bins)) if fill[i] < capacity]
    alive = len(bins)
    while alive > needed:
        before = alive
        for donor in sorted(under, key=lambda i: fill[i]):
            if not bins[donor]:
                continue
            while bins[donor] and _give(donor, bins, fill, sizes, capacity, under):
                pass
            if not bins[donor]:
                alive -= 1
            if alive == needed:
                break
        under = [i for i in under if bins[i] and fill[i] < capacity]
        if alive == before:
            break
    return [b for b in bins if b]


def _give(donor: int, bins: list[list[int]], fill: np.ndarray, sizes: np.ndarray, capacity: int, under: list[int]) -> bool:
    """One exchange out of ``donor`` into a bin at least as full; False if none gains."""
    others = np.array([i for i in under if i != donor and bins[i] and fill[donor] <= fill[i] < capacity], np.int64)
    if not len(others):
        return False
    room = capacity - fill[others]
    mine = bins[donor]
    own = sizes[mine]
    for k in np.argsort(-own, kind="stable").tolist():  # move
        fits = np.flatnonzero(room >= own[k])
        if len(fits):
            to = int(others[fits[np.argmin(room[fits])]])
            return _exchange(donor, to, [mine[k]], [], bins, fill, sizes)
    theirs = np.array([i for o in others.tolist() for i in bins[o]], np.int64)
    holder = np.repeat(np.arange(len(others)), [len(bins[o]) for o in others.tolist()])
    length, gap = sizes[theirs], room[holder]
    best, choice = 0, None
    gives = [[k] for k in range(len(mine))] + [[a, b] for a in range(min(len(mine), 24)) for b in range(a)]
    for give in gives:  # one for one, two for one
        gain = int(own[give].sum()) - length
        gain[(gain > gap) | (gain <= 0)] = 0
        at = int(np.argmax(gain))
        if gain[at] > best:
            best, choice = int(gain[at]), (give, int(holder[at]), [int(theirs[at])])
    if choice is None:  # one for two of a neighbouring pair
        pair = np.flatnonzero(holder[1:] == holder[:-1])
        both, gap = length[pair] + length[pair + 1], gap[pair]
        for k in range(len(mine)):
            gain = int(own[k]) - both
            gain[(gain > gap) | (gain <= 0)] = 0
            if len(gain) and gain.max() > best:
                at = int(np.argmax(gain))
                best, choice = int(gain[at]), ([k], int(holder[pair[at]]), [int(theirs[pair[at]]), int(theirs[pair[at] + 1])])
    if choice is None:
        return False
    give, to, back = choice
    return _exchange(donor, int(others[to]), [mine[k] for k in give], back, bins, fill, sizes)


def _exchange(donor: int, to: int, give: list[int], back: list[int], bins: list[list[int]], fill: np.ndarray, sizes: np.ndarray) -> bool:
    gain = int(sizes[give].sum()) - int(sizes[back].sum() if back else 0)
    bins[donor] = [i for i in bins[donor] if i not in give] + back
    bins[to] = [i for i in bins[to] if i not in back] + give
    fill[donor] -= gain
    fill[to] += gain
    return True


def _filler(capacity: int, base: int):
    """Fills the items of one block into bins numbered from ``base``."""

    def fill(key, table):
        sizes = table["length"].to_numpy().astype(np.int64)
        bins = swap_search(best_fit(sizes, capacity), sizes, capacity)
        order = np.array([i for b in bins for i in b], np.int64)
        number = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        ends = np.cumsum(sizes[order])
        starts = ends - sizes[order]
        first = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
        filled = np.diff(np.append(starts[first], ends[-1]))
        return pa.table({
            "row": table["row"].take(pa.array(order)),
            "length": pa.array(sizes[order]),
            "sequence_id": pa.array(base + (key[0].as_py() << 24) + number),
            "offset": pa.array(starts - starts[first][number]),
            "full": pa.array((filled == capacity)[number]),
        })

    return fill


def pack_lengths(items: DataFrame, capacity: int = 1024, block: int = 8192) -> DataFrame:
    """(row, sequence_id, offset) for items (row long, unique; length from 1 to ``capacity``), stored tables.

    Items of full length are sequences of their own. The others are dealt by a
    hash to blocks of about ``block`` items; each block is filled best-fit and improved by
    exchanges. What lies in underfull bins is dealt anew to fewer blocks, as long as that
    takes a tenth of it at least, until one block is left.
    """
    full = items.where(F.col("length") == capacity).select("row", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    done, rest = [full], items.where(F.col("length") < capacity).select("row", "length")
    count, turn = rest.count(), 0
    while count:
        blocks = -(-count // block)
        dealt = rest.withColumn("_block", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(blocks)))
        packed = saved(dealt.groupBy("_block").applyInArrow(_filler(capacity, turn << 56), "row long, length long, sequence_id long, offset long, full boolean"), "packed")
        rest = packed.where("not full").select("row", "length")
        left = rest.count() if blocks > 1 else 0
        last = left > 0.9 * count or not left
        done.append((packed if last else packed.where("full")).select("row", "sequence_id", "offset"))
        count, turn = (0 if last else left), turn + 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 1024, end_id: int = 2, ids_out: bool = True, tokenizer: str = "byte_bpe_50k") -> DataFrame:
    """Pack all texts into sequences of at most ``length`` tokens; one row per piece.

    Returns (id, piece, start, length, ids_crc32, sequence_id, offset) and, with
    ``ids_out``, the piece's ``ids``. Offsets within a sequence are gapless from 0. Rows with a null id are packed
    like others; repeated rows are packed repeatedly; an empty table gives no rows.
    """
    pieces = token_pieces(docs, id_col, text_col, length, end_id, tokenizer).withColumn("ids_crc32", F.crc32("ids"))
    pieces = saved((pieces if ids_out else pieces.drop("ids")).withColumn("row", F.monotonically_increasing_id()), "pieces")
    packed = pieces.join(pack_lengths(pieces.select("row", "length"), length), "row").drop("row")
    return packed.withColumnRenamed("id", id_col)
