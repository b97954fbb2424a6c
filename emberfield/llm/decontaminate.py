"""Benchmark decontamination: exact pieces find places, bit-parallel edit distance verifies them."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfield.llm.blocks import slices

_LEAKS = "array<struct<item_id:long,distance:int,budget:int,start:long,stop:long>>"
_KIND = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("budget", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())]))


def normalise(text: str | None) -> str:
    """Lower case, white space as single spaces."""
    return " ".join(text.lower().split()) if text else ""


@dataclass(frozen=True)
class Item:
    """A test item with its error budget and the bit mask of each of its characters."""

    item_id: int
    text: str
    budget: int
    bordered: bool = False  # found only between word borders

    def pieces(self) -> Iterator[tuple[int, str]]:
        """``budget`` + 1 pieces of nearly equal length: with at most ``budget`` errors one is intact."""
        n, size = self.budget + 1, len(self.text)
        for j in range(n):
            yield size * j // n, self.text[size * j // n : size * (j + 1) // n]


def nearest_end(masks: dict[str, int], size: int, text: str) -> tuple[int, int]:
    """Smallest edit distance of a pattern to any substring of ``text``, and where the first such substring ends.

    Myers' bit-parallel columns: bit i of ``plus`` (``minus``) says that the distance rises
    (falls) from pattern row i to i + 1; a match may start anywhere, so the first row stays 0.
    """
    full, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score = full, 0, size
    best, end = size, 0
    for j, c in enumerate(text):
        equal = masks.get(c, 0)
        vertical = equal | minus
        diagonal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (~(diagonal | plus) & full)
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus = down | (~(vertical | up) & full)
        minus = up & vertical
        if score < best:
            best, end = score, j + 1
    return best, end


def _joins(a: str, b: str) -> bool:
    """Whether two neighbours are of one word: both letters or digits, of scripts that part words by spaces."""
    return a.isalnum() and b.isalnum() and max(a, b) < "\u2e80"


class Searcher:
    """All items at once: an automaton of their pieces, and the verification of what it finds."""

    def __init__(self, items: list[Item]):
        self.items = items
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, item in enumerate(items):
            for offset, piece in item.pieces():
                places[piece].append((n, offset + len(piece) - 1))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, where)
        if places:
            self.automaton.make_automaton()
        self._masks: dict[int, dict[str, int]] = {}

    def _mask(self, n: int) -> dict[str, int]:
        if n not in self._masks:
            masks: dict[str, int] = {}
            for i, c in enumerate(self.items[n].text):
                masks[c] = masks.get(c, 0) | 1 << i
            self._masks[n] = masks
        return self._masks[n]

    def find(self, text: str | None) -> list[dict]:
        text = normalise(text)
        if not text or not self.items:
            return []
        starts: dict[int, set[int]] = defaultdict(set)
        for end, where in self.automaton.iter(text):
            for n, last in where:
                item = self.items[n]
                begin, stop = end - last, end - last + len(item.text)
                if item.bordered and (begin and _joins(text[begin - 1], item.text[0]) or stop < len(text) and _joins(item.text[-1], text[stop])):
                    continue
                starts[n].add(begin)
        found = []
        for n in sorted(starts):
            item = self.items[n]
            size, budget = len(item.text), item.budget
            best, at = budget + 1, 0
            low = high = None
            for s in [*sorted(starts[n]), None]:  # one window for starts that lie close together
                if low is not None and (s is None or s - high > size):
                    a, b = max(0, low - budget), high + size + budget
                    distance, stop = nearest_end(self._mask(n), size, text[a:b])
                    if distance < best:
                        best, at = distance, a + stop
                    low = None
                if s is not None:
                    low, high = (s if low is None else low), s
            if best <= budget:
                found.append({"item_id": item.item_id, "distance": best, "budget": budget, "start": max(0, at - size), "stop": at})
        return found


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    error_rate: float = 0.08,
    least_chars: int = 16,
    least_exact: int = 6,
    block_chars: int = 4 << 20,
    keep_text: bool = True,
) -> DataFrame:
    """Adds ``leaks``: the test items found in each whole text within their error budget.

    An item's budget is ``error_rate`` of its length, in characters inserted, deleted or replaced, after
    lower-casing and collapsing white space on both sides. Each item is cut into one piece more than its
    budget; a text within the budget holds a piece unchanged, so none is missed. ``start`` (about, from
    the item's length) and ``stop`` are places in the normalised text of the best match.

    Items are sent to the tasks in blocks of about ``block_chars`` characters, one pass over the documents for
    each block. Items shorter than ``least_chars`` must stand in the text without an error and between
    word borders (scripts without spaces have none). Null items and those shorter than ``least_exact`` are no evidence and not
    searched; ``unsearched`` returns them. Items with a null id are reported with a null id. Null and empty texts have no leaks. No row is dropped; ``leaks`` replaces a column of that name.
    """
    spark = docs.sparkSession
    items = items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).where("t is not null")
    blocks = max(1, -(-(items.agg(F.sum(F.length("t"))).first()[0] or 0) // block_chars))
    out = docs.select([c for c in docs.columns if c != "leaks"]).withColumn("leaks", F.array().cast(_LEAKS))
    for block in range(blocks):
        mine = items if blocks == 1 else items.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == block)
        texts = sorted({(i if i is not None else -1, i is None, normalise(t)) for i, t in mine.collect()})  # a block at a time
        block_items = [Item(None if unknown else i, t, 0 if len(t) < least_chars else int(error_rate * len(t)), len(t) < least_chars) for i, unknown, t in texts if len(t) >= least_exact]
        out = _search(out, spark.sparkContext.broadcast(block_items), text_col)
    return out if keep_text else out.drop(text_col)


def unsearched(items: DataFrame, item_id: str = "item_id", item_text: str = "text", least_exact: int = 6) -> DataFrame:
    """The rows of ``items`` that ``find_leaks`` does not look for: null, or shorter than ``least_exact`` after normalising."""

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([len(normalise(t)) < least_exact for t in b.column(1).to_pylist()], pa.bool_()))

    read = items.select(item_id, item_text)
    return read.mapInArrow(short, read.schema)


def _search(docs: DataFrame, items, text_col: str) -> DataFrame:
    text_at, leaks_at = docs.columns.index(text_col), docs.columns.index("leaks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(items.value)
        for b in slices(batches):
            leaks = [old + searcher.find(t) for t, old in zip(b.column(text_at).to_pylist(), b.column(leaks_at).to_pylist(), strict=True)]
            columns = list(b.columns)
            columns[leaks_at] = pa.array(leaks, _KIND)
            yield pa.RecordBatch.from_arrays(columns, b.schema.names)

    return docs.mapInArrow(run, docs.schema)
