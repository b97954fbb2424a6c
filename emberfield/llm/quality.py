"""Quality rules: document statistics, and boosted trees over them as flat numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfield.llm.blocks import saved, slices
from emberfield.llm.words import Windows, WordHashes, split_words

_BLANKS = " \t\n\v\f\r"
_SYMBOLS = "#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_lines", "n_distinct_words", "n_upper", "n_digits", "n_stops"]
FEATURES = ["words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "line_words", "distinct_share", "upper_share", "digit_share", "stop_share"]
#: Quality never rises with these: more symbols, repeated lines or repeated words.
DECREASING = ("symbol_share", "dup_line_share", "repeat_share")


class TextStatistics:
    """Counts of one text; see ``BASE`` and ``EXTRA`` for their order."""

    def __init__(self):
        self._hashes, self._windows = WordHashes(), Windows(3)

    def of(self, text: str | None) -> list[int]:
        if not text:
            return [0] * (len(BASE) + len(EXTRA))
        words = split_words(text)
        hashes = self._hashes.of(words)
        repeated = 0
        if len(words) >= 4:
            _, inverse, counts = np.unique(self._windows.of(hashes), return_inverse=True, return_counts=True)
            often = (counts > 1)[inverse]
            covered = np.zeros(len(words), bool)
            for k in range(3):
                covered[k : len(words) - 2 + k] |= often
            repeated = int(covered.sum())
        lines = [line for line in text.split("\n") if line.strip(_BLANKS)]
        return [
            len(words),
            len(text) - sum(map(text.count, _BLANKS)),
            sum(map(text.count, _SYMBOLS)),
            len(lines) - len(set(lines)),
            repeated,
            len(lines),
            len(np.unique(hashes)),
            sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
            sum(map(text.count, "0123456789")),
            sum(map(text.count, ".!?")),
        ]


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``BASE``, ``EXTRA``), all long, for every whole text; a null or empty text has only zeros.

    ``n_dup_lines`` are lines with a word that equal an earlier line;
    ``n_repeat_words`` are words in three-word windows found twice or more.
    """
    names = BASE + EXTRA

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stats = TextStatistics()
        for b in slices(batches):
            rows = np.array([stats.of(t) for t in b.column(1).to_pylist()], np.int64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(rows[:, i]) for i in range(len(names))]], ["id", *names])

    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col))
    return read.mapInArrow(run, "id long, " + ", ".join(f"{n} long" for n in names)).withColumnRenamed("id", id_col)


def features(stats: dict[str, np.ndarray]) -> np.ndarray:
    """One row per document, columns as in ``FEATURES``."""
    s = {k: v.astype(np.float64) for k, v in stats.items()}
    words, chars, lines = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1), np.maximum(s["n_lines"], 1)
    return np.column_stack([
        s["n_words"], s["word_chars"] / words, s["n_symbols"] / chars, s["n_dup_lines"] / lines, s["n_repeat_words"] / words,
        s["n_words"] / lines, s["n_distinct_words"] / words, s["n_upper"] / chars, s["n_digits"] / chars, s["n_stops"] / words,
    ])


@dataclass
class Forest:
    """Trees as node arrays, one row per tree: go left where feature <= threshold; leaves point to themselves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    bias: float

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality; all trees step down together, a level at a time."""
        out = np.empty(len(x))
        trees = np.arange(len(self.feature))
        for i in range(0, len(x), 4096):
            part = x[i : i + 4096]
            node = np.zeros((len(part), len(trees)), np.int64)
            rows = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                goes = part[rows, self.feature[trees, node]] <= self.threshold[trees, node]
                node = np.where(goes, self.left[trees, node], self.right[trees, node])
            out[i : i + 4096] = self.value[trees, node].sum(axis=1) + self.bias
        return 1 / (1 + np.exp(-out))


def _leaf(g: np.ndarray, h: np.ndarray, penalty: float) -> np.ndarray:
    return -g / (h + penalty)


def _score(g, h, w, penalty: float):
    return -(g * w + 0.5 * (h + penalty) * w * w)


def fit_forest(
    x: np.ndarray, y: np.ndarray, signs: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, penalty: float = 1.0, least: float = 5.0
) -> Forest:
    """Gradient-boosted trees for 0/1 labels with logistic loss.

    Values are cut into ``bins`` quantile bins. ``signs`` is +1, -1 or 0 per feature:
    the score never falls, never rises, or is free in it. A split on a signed feature must
    order its children's values, and their middle then bounds all nodes below either side.
    """
    n, k = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(k)]
    codes = np.column_stack([np.searchsorted(edges[f], x[:, f], "left") for f in range(k)])  # code <= i exactly where x <= edge i
    rate_of_ones = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    margin = np.full(n, bias)
    size = 2 ** (depth + 1) - 1
    shape = (trees, size)
    forest = Forest(np.zeros(shape, np.int64), np.full(shape, np.inf), np.tile(np.arange(size), (trees, 1)), np.tile(np.arange(size), (trees, 1)), np.zeros(shape), depth, bias)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        work = [(0, np.arange(n), 0, -np.inf, np.inf)]
        while work:
            node, rows, level, low, high = work.pop()
            g, h = grad[rows], hess[rows]
            whole = float(np.clip(_leaf(g.sum(), h.sum(), penalty), low, high))
            best, choice = 1e-6, None
            for f in range(k) if level < depth else ():
                if not len(edges[f]):
                    continue
                gl = np.cumsum(np.bincount(codes[rows, f], g, len(edges[f]) + 1))[:-1]
                hl = np.cumsum(np.bincount(codes[rows, f], h, len(edges[f]) + 1))[:-1]
                gr, hr = g.sum() - gl, h.sum() - hl
                wl, wr = np.clip(_leaf(gl, hl, penalty), low, high), np.clip(_leaf(gr, hr, penalty), low, high)
                gain = _score(gl, hl, wl, penalty) + _score(gr, hr, wr, penalty) - _score(g.sum(), h.sum(), whole, penalty)
                gain[(hl < least * 0.1) | (hr < least * 0.1) | (signs[f] * (wr - wl) < 0)] = 0
                at = int(np.argmax(gain))
                if gain[at] > best:
                    best, choice = float(gain[at]), (f, at, float(wl[at]), float(wr[at]))
            if choice is None:
                forest.value[t, node] = rate * whole
                margin[rows] += rate * whole
                continue
            f, at, wl, wr = choice
            forest.feature[t, node], forest.threshold[t, node] = f, edges[f][at]
            forest.left[t, node], forest.right[t, node] = 2 * node + 1, 2 * node + 2
            goes = codes[rows, f] <= at
            middle = (wl + wr) / 2
            bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[int(signs[f])]
            work.append((2 * node + 1, rows[goes], level + 1, *bounds[0]))
            work.append((2 * node + 2, rows[~goes], level + 1, *bounds[1]))
    return forest


def train_quality(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", sample: int = 20_000) -> Forest | None:
    """Fit on at most ``sample`` labelled documents, those with the smallest hashes of the id; None without labels of both kinds.

    Null labels are left out; a document labelled both ways counts as good.
    """
    marked = labels.where(F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).cast("double").alias("_label"))
    labelled = saved(stats.join(marked, id_col).withColumn("_hash", F.pmod(F.xxhash64(id_col), F.lit(1 << 30))), "labelled")
    share = min(1.0, 1.1 * sample / max(1, labelled.count()))  # so that each task offers its share only
    offered = labelled.where(F.col("_hash") < int(share * (1 << 30)) + 1)
    known = offered.orderBy("_hash", id_col).limit(sample).select(*BASE, *EXTRA, "_label").toPandas()
    y = known["_label"].to_numpy()
    if len(np.unique(y)) < 2:
        return None
    signs = np.array([-1 if f in DECREASING else 0 for f in FEATURES])
    return fit_forest(features({c: known[c].to_numpy() for c in BASE + EXTRA}), y, signs)


def judge(stats: DataFrame, forest: Forest | None, threshold: float = 0.5) -> DataFrame:
    """Adds base_failed (fewer than 50 words, or over half of them in repeated windows), quality and kept.

    ``kept`` needs the base rules and a quality of at least ``threshold``; without a forest only the base rules.
    """
    based = stats.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    if forest is None:
        return based.withColumns({"quality": F.lit(None).cast("double"), "kept": ~F.col("base_failed")})
    shared = stats.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = {c: b.column(b.schema.get_field_index(c)).to_numpy() for c in BASE + EXTRA}
            scored = shared.value.predict(features(columns)) if b.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scored)], [*b.schema.names, "quality"])

    schema = based.withColumn("quality", F.lit(0.0)).schema
    return based.mapInArrow(run, schema).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics, base rules and the forest's verdict for every document.

    Other columns of ``docs`` are ignored; repeated rows are judged alike, and no documents give no rows.
    """
    stats = saved(text_statistics(docs, id_col, text_col), "statistics")
    return judge(stats, train_quality(stats.dropDuplicates([id_col]), labels, id_col))
