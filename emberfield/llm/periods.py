"""Periodic runs of words: stretches that repeat one passage at least four times over.

Longest common extensions come from suffixes sampled by a difference cover: only
those are sorted, a pair of places compares few words until both reach a sample, and
the rest is a range minimum over the sorted samples. Runs are found on a grid: for
each period q, places 3q apart are enough, which makes n log n places in all.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberfield.llm.blocks import slices
from emberfield.llm.words import split_words

_MODULUS = 31
_COVER = (0, 1, 3, 8, 12, 18)  # every difference modulo 31 is one of two of these
_RESIDUES = np.array(_COVER)
#: Least number of words of a run, and least number of periods in it.
LEAST_WORDS, LEAST_PERIODS = 6, 4


def _shifts() -> np.ndarray:
    """For residues a and b the smallest step after which both are in the cover."""
    inside = np.isin(np.arange(2 * _MODULUS) % _MODULUS, _RESIDUES)
    out = np.empty((_MODULUS, _MODULUS), np.int64)
    for a, b in itertools.product(range(_MODULUS), repeat=2):
        out[a, b] = np.flatnonzero(inside[a : a + _MODULUS] & inside[b : b + _MODULUS])[0]
    return out


_SHIFTS = _shifts()
_PLACE = np.full(_MODULUS, -1)
_PLACE[_RESIDUES] = np.arange(len(_RESIDUES))


def _refine(rank: np.ndarray, keys: np.ndarray, tied: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks divided further by ``keys`` within ties; a rank is the number of smaller entries. Returns those still tied."""
    order = tied[np.lexsort((keys[tied], rank[tied]))]
    r, k = rank[order], keys[order]
    at = np.arange(len(order))
    old = np.concatenate([[True], r[1:] != r[:-1]])
    new = old | np.concatenate([[True], k[1:] != k[:-1]])
    old_start, new_start = np.maximum.accumulate(np.where(old, at, 0)), np.maximum.accumulate(np.where(new, at, 0))
    rank = rank.copy()
    rank[order] = r + new_start - old_start
    alone = new & np.concatenate([new[1:], [True]])
    return rank, order[~alone]


class Extensions:
    """Number of equal symbols from two places on, for any pairs of places.

    ``symbols`` are non-negative integers; one that occurs once ends every extension,
    and the last must be such. A fifth of the suffixes is sampled; the tables hold about log n numbers for each.
    """

    def __init__(self, symbols: np.ndarray):
        self.symbols = np.concatenate([symbols, np.zeros(2 * _MODULUS, symbols.dtype)])
        n = len(symbols)
        self.per = -(-n // _MODULUS) + 1  # samples of one residue
        places = (np.arange(self.per) * _MODULUS + _RESIDUES[:, None]).ravel()
        real = places < n
        rank = np.where(real, 0, real.sum() - 1 + np.cumsum(~real))  # places past the end are apart from all
        tied = np.flatnonzero(real)
        for step in range(_MODULUS):
            if not len(tied):
                break
            keys = np.zeros(len(places), self.symbols.dtype)
            keys[tied] = self.symbols[places[tied] + step]
            rank, tied = _refine(rank, keys, tied)
        levels, half = [rank], 1
        while len(tied):  # blocks of MODULUS * half symbols are ranked
            keys = np.zeros(len(places), rank.dtype)
            keys[tied] = rank[tied + half]
            rank, tied = _refine(rank, keys, tied)
            levels.append(rank)
            half *= 2
        self.rank = rank
        order = np.empty(len(places), np.int64)
        order[rank] = np.arange(len(places))
        self.table = [self._neighbours(order, places, levels)]
        width = 1
        while 2 * width <= len(places):
            low = self.table[-1]
            self.table.append(np.minimum(low[:-width], low[width:]))
            width *= 2

    def _neighbours(self, order: np.ndarray, places: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Equal symbols of each sampled suffix and the one before it in order."""
        a, b = order[:-1].copy(), order[1:].copy()
        out = np.zeros(len(order), np.int32)
        for level in range(len(levels) - 1, -1, -1):
            rank, half = levels[level], 1 << level
            same = np.flatnonzero(rank[np.minimum(a, len(rank) - 1)] == rank[np.minimum(b, len(rank) - 1)])
            out[1 + same] += half * _MODULUS
            a[same] += half
            b[same] += half
        inside = np.flatnonzero(np.maximum(places[order[:-1]], places[order[1:]]) + out[1:] < len(self.symbols) - _MODULUS)
        x, y = places[order[inside]] + out[1 + inside], places[order[inside + 1]] + out[1 + inside]
        out[1 + inside] += self._direct(x, y, np.full(len(x), _MODULUS, np.int64)).astype(np.int32)
        return out

    def _direct(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal symbols from ``a`` and ``b`` on, compared one by one up to ``most``."""
        out = np.zeros(len(a), np.int64)
        alive = np.flatnonzero(most > 0)
        step = 0
        while len(alive):
            alive = alive[self.symbols[a[alive] + step] == self.symbols[b[alive] + step]]
            out[alive] += 1
            step += 1
            alive = alive[most[alive] > step]
        return out

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal symbols from ``a`` and ``b`` on; a place is not compared with itself."""
        shift = _SHIFTS[a % _MODULUS, b % _MODULUS]
        out = self._direct(a, b, shift)
        whole = np.flatnonzero(out == shift)
        x, y = a[whole] + shift[whole], b[whole] + shift[whole]
        x, y = (self.rank[_PLACE[p % _MODULUS] * self.per + p // _MODULUS] for p in (x, y))
        low, high = np.minimum(x, y) + 1, np.maximum(x, y) + 1
        level = np.frexp(high - low)[1] - 1
        rest = np.empty(len(whole), np.int64)
        for k in np.unique(level):
            here = np.flatnonzero(level == k)
            row = self.table[k]
            rest[here] = np.minimum(row[low[here]], row[high[here] - (1 << int(k))])
        out[whole] += rest
        return out


def _grid(n: int, periods: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places i and periods q with i a multiple of 3q and i + q < n."""
    counts = (n - 1 - periods) // (3 * periods) + 1
    q = np.repeat(periods, counts)
    return (np.arange(len(q)) - np.repeat(np.cumsum(counts) - counts, counts)) * 3 * q, q


def _candidates(symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, at_once: int = 2_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places i and periods q of the grids of all texts whose words i and i + q are equal.

    A run of period q has at least 3q places in a row where a word equals the one q on, so the grid meets each run.
    """
    for start, n in zip(starts.tolist(), lengths.tolist(), strict=True):
        low, top = 1, n // LEAST_PERIODS
        while low <= top:
            high, room = low, at_once
            while high <= top and room > 0:  # periods of one slice; small ones have the most places
                step = min(top + 1 - high, max(1, room * 3 * high // max(n, 1)))
                room -= step * (n // (3 * high) + 1)
                high += step
            i, q = _grid(n, np.arange(low, high))
            equal = np.flatnonzero(symbols[start + i] == symbols[start + i + q])
            if len(equal):
                yield start + i[equal], q[equal]
            low = high


def find_runs(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Per text the rows (start, length, period) of all its runs, by start, then period.

    ``texts`` are arrays of word numbers. A run is a stretch with smallest period q, of at least ``LEAST_WORDS`` words and
    ``LEAST_PERIODS`` periods, that no neighbour extends.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    top = max((int(t.max()) for t in texts if len(t)), default=0) + 1
    # texts stand between symbols that occur once, so nothing extends beyond its text either way
    starts = np.cumsum(lengths + 1) - lengths
    symbols = np.empty(int(lengths.sum()) + len(texts) + 1, np.int64)
    symbols[np.append(starts - 1, len(symbols) - 1)] = top + np.arange(len(texts) + 1)
    for start, t in zip(starts.tolist(), texts, strict=True):
        symbols[start : start + len(t)] = t
    found = list(_candidates(symbols, starts, lengths))
    out = np.empty((0, 3), np.int64)
    if found:
        i, q = (np.concatenate(x) for x in zip(*found, strict=True))
        del found
        ahead = Extensions(symbols).of(i, i + q)
        behind = Extensions(symbols[::-1].copy()).of(len(symbols) - i, len(symbols) - i - q)
        length = ahead + behind + q
        good = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
        start, length, q = (i - behind)[good], length[good], q[good]
        order = np.lexsort((q, length, start))
        start, length, q = start[order], length[order], q[order]
        # the same stretch was found with each multiple of its period
        first = np.concatenate([[True], (start[1:] != start[:-1]) | (length[1:] != length[:-1])]) if len(start) else np.empty(0, bool)
        out = np.stack([start[first], length[first], q[first]], axis=1)
        out = out[np.lexsort((out[:, 2], out[:, 0]))]
    text = np.searchsorted(starts, out[:, 0], "right") - 1
    out[:, 0] -= starts[text] if len(starts) else 0
    return np.split(out, np.searchsorted(text, np.arange(1, len(texts)))) if len(texts) else []


def folded(words: list, doc_id) -> list:
    """For one id in ten, the words with a passage repeated from a place on; see the query ``op13``.

    With h = crc32 of the decimal id, g = h // 10 and h % 10 = 0, each word i >= a is word a + (i - a) % p, a = g % n, p = 1 + (n - a) // (3 + g % 8).
    """
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


_OUTPUTS = "n_words long, runs array<struct<start:long,length:long,period:long>>, best struct<start:long,length:long,period:long>, runs_sha256 string, kept_sha256 string, kept_text string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_KINDS = [pa.int64(), pa.list_(_RUN), _RUN, pa.string(), pa.string(), pa.string()]


def _judged(words: list[bytes], runs: np.ndarray, texts_out: bool) -> tuple:
    rows = runs.tolist()
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
    np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
    kept = b" ".join(itertools.compress(words, (np.cumsum(gone)[:-1] == 0).tolist()) if rows else words)
    best = min(rows, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    named = [dict(zip(("start", "length", "period"), r, strict=True)) for r in rows]
    return (
        len(words), named, best and dict(zip(("start", "length", "period"), best, strict=True)),
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in rows).encode()).hexdigest(),
        hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass") if texts_out else None,
    )


def periodic_runs(docs: DataFrame, text_col: str = "text", fold_by: str | None = None, texts_out: bool = True, batch_words: int = 100_000) -> DataFrame:
    """Runs of every whole text, and the text without what they repeat.

    Returns the input's columns plus ``n_words``, ``runs`` (start, length, period of each, by start, then period), ``best``
    (the one with the greatest length / period, compared exactly; ties: smallest start, then period; null without
    a run), ``runs_sha256`` (of every run's ``start,length,period`` and a line feed), ``kept_sha256`` (of the
    words left, joined by one space) and, unless ``texts_out`` is off, ``kept_text``. A word goes if a run contains it after
    that run's first period. ``fold_by`` names an id column by which some texts are ``folded`` first.

    Null and empty texts have no words and no runs. Rows are judged each by itself, so repeated rows get equal
    results; an id that is null is spelled None. Input columns with an output's name are replaced. Texts share the
    arrays of a batch of ``batch_words`` words or of one longer text.
    """
    fields = [f for f in T._parse_datatype_string(_OUTPUTS).fields if texts_out or f.name != "kept_text"]
    names = [f.name for f in fields]
    docs = docs.select([c for c in docs.columns if c not in names])
    at, by = docs.columns.index(text_col), docs.columns.index(fold_by) if fold_by else None

    def judge(rows: pa.RecordBatch, words: list[list[bytes]]) -> pa.RecordBatch:
        numbers: dict[bytes, int] = {}
        coded = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in ws), np.int64, len(ws)) for ws in words]
        out = [_judged(ws, runs, texts_out) for ws, runs in zip(words, find_runs(coded), strict=True)]
        arrays = [pa.array([o[k] for o in out], kind) for k, kind in enumerate(_KINDS[: len(fields)])]
        return pa.RecordBatch.from_arrays([*rows.columns, *arrays], [*rows.schema.names, *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            begin, size, held = 0, 0, []
            ids = b.column(by).to_pylist() if by is not None else None
            for i, text in enumerate(b.column(at).to_pylist()):
                words = split_words(text)
                held.append(folded(words, ids[i]) if ids else words)
                size += len(words)
                if size >= batch_words or i + 1 == b.num_rows:
                    yield judge(b.slice(begin, i + 1 - begin), held)
                    begin, size, held = i + 1, 0, []

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields])).select(
        *docs.columns, *[F.col(n) for n in names]
    )
