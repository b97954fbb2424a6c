"""Language identification: known words first, then shorter and shorter character n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfield.llm.blocks import saved, slices

UNDETERMINED = "und"
_WORD = re.compile(r"[^\W\d_]+")


def letter_words(text: str | None) -> list[str]:
    """Lower-cased runs of letters of a whole text."""
    if not text:
        return []
    found = _WORD.findall(text.lower())
    return found if text.isascii() else [w for w in found if w.isalpha() or any(c.isalpha() for c in w)]


def word_counts(labelled: DataFrame) -> DataFrame:
    """(lang, word, n) over all rows of ``labelled`` (text, lang), summed per task before they are exchanged."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(seen: dict[str, Counter]) -> pa.RecordBatch:
            langs = [lang for lang, c in seen.items() for _ in range(len(c))]
            words = [w for c in seen.values() for w in c]
            counts = [n for c in seen.values() for n in c.values()]
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["lang", "word", "n"])

        seen: dict[str, Counter] = {}
        for b in slices(batches):
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                seen.setdefault(lang, Counter()).update(letter_words(text))
            if sum(map(len, seen.values())) > 200_000:  # bounded memory
                yield out(seen)
                seen = {}
        yield out(seen)

    return labelled.select("text", "lang").mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


@dataclass
class LanguageModel:
    """Log frequencies per language of words and of n-grams by length; rows of ``scores``."""

    langs: list[str]
    words: dict[str, int]
    grams: list[dict[str, int]]  # longest first
    scores: np.ndarray  # one row per entry, one column per language; the last for a word of which not even one character is known

    def rows(self, word: str) -> list[int]:
        """Rows whose mean scores a word: its own, else those of the longest n-grams known of it."""
        at = self.words.get(word)
        if at is not None:
            return [at]
        padded = f" {word} "
        for known, size in zip(self.grams, range(len(self.grams), 0, -1), strict=True):
            rows = [r for i in range(len(padded) - size + 1) if (r := known.get(padded[i : i + size])) is not None]
            if rows:
                return rows
        return [len(self.scores) - 1]


def training_rows(labelled: DataFrame, lang_chars: int) -> DataFrame:
    """A sample of about ``lang_chars`` characters of each language's rows (text, lang), all of a language that has fewer.

    Rows are taken by a hash of their text, so the sample does not depend on how the table is divided. Null langs are left out.
    """
    known = labelled.select("text", "lang").where("lang is not null")
    chars = dict(known.groupBy("lang").agg(F.sum(F.length("text"))).collect())  # one row per language
    shares = {lang: lang_chars / n for lang, n in chars.items() if n and n > lang_chars}
    if not shares:
        return known
    share = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in shares.items() for x in pair]), F.col("lang")), F.lit(1.0))
    return known.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share * (1 << 20))


def train(labelled: DataFrame, lang_chars: int = 4 << 20, max_length: int = 4) -> LanguageModel:
    """Count words and their n-grams up to ``max_length`` over a sample of the labelled rows (text, lang).

    The only bound is that of the sample, ``training_rows``: the model keeps every word and n-gram in it, so
    its size does not grow with the corpus and no entry is left out for being rare.
    """
    counts = saved(word_counts(training_rows(labelled, lang_chars)), "words")
    totals = dict(counts.groupBy("lang").agg(F.sum("n")).orderBy("lang").collect())
    langs = list(totals)
    k = len(langs)

    def best(df: DataFrame, key: str) -> tuple[list, list, np.ndarray]:
        rows = df.select("lang", key, "n").orderBy(key, "lang").toArrow()  # bounded by the sample
        return rows["lang"].to_pylist(), rows[key].to_pylist(), rows["n"].to_numpy()

    number = {lang: i for i, lang in enumerate(langs)}
    blocks: list[np.ndarray] = []

    def scored(rows: tuple[list, list, np.ndarray], sums: dict[str, int], first: int) -> dict[str, int]:
        """Log of the smoothed frequency of each entry in each language."""
        index: dict[str, int] = {}
        at = np.array([index.setdefault(key, len(index)) for key in rows[1]], np.int64)
        n = np.full((len(index), k), 0.5)
        np.add.at(n, (at, np.array([number[lang] for lang in rows[0]], np.int64)), rows[2])
        whole = np.array([max(1, sums.get(lang, 0)) for lang in langs], float)
        blocks.append(np.log(n / (whole + 0.5 * len(index))).astype(np.float32))
        return {key: first + i for key, i in index.items()}

    if not k:
        return LanguageModel([], {}, [], np.empty((0, 0), np.float32))
    words = scored(best(counts, "word"), totals, 0)
    grams, first = [], len(words)
    padded = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    for size in range(max_length, 0, -1):
        spots = F.transform(F.sequence(F.lit(1), F.length(padded) - size + 1), lambda i, size=size: F.substring(padded, i, F.lit(size)))
        exploded = counts.where(F.length("word") + 2 >= size).select("lang", "n", F.explode(spots).alias("gram"))
        per_gram = saved(exploded.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
        sums = dict(per_gram.groupBy("lang").agg(F.sum("n")).collect())
        known = scored(best(per_gram, "gram"), sums, first)
        grams.append(known)
        first += len(known)
    return LanguageModel(langs, words, grams, np.concatenate([*blocks, np.zeros((1, k), np.float32)]))


class _Scores:
    """Scores of each word met, worked out once; emptied when they outgrow the limit."""

    def __init__(self, model: LanguageModel, limit: int = 200_000):
        self.model, self.limit = model, limit
        self.at: dict[str, int] = {}
        self.table = np.empty((limit, len(model.langs)), np.float32)

    def _learn(self, words: list[str]) -> None:
        rows = [self.model.rows(w) for w in words]
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = np.fromiter((r for of_word in rows for r in of_word), np.int64, int(lengths.sum()))
        first = len(self.at)
        sums = np.add.reduceat(self.model.scores[flat], np.cumsum(lengths) - lengths, axis=0)
        self.table[first : first + len(words)] = sums / lengths[:, None]
        self.at.update(zip(words, range(first, first + len(words)), strict=True))

    def total(self, words: list[str]) -> np.ndarray:
        sums = np.zeros(len(self.model.langs))
        for i in range(0, len(words), 50_000):
            part = words[i : i + 50_000]
            if len(self.at) + 50_000 > self.limit:
                self.at.clear()
            new = set(part).difference(self.at)
            if new:
                self._learn(list(new))
            sums += self.table[np.fromiter(map(self.at.__getitem__, part), np.int64, len(part))].sum(axis=0, dtype=np.float64)
        return sums


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to ``docs`` (without the text, if it is not kept) from the whole text alone.

    Scores of all words are summed per language; ``score`` is the share of the best
    language when the sums are turned into probabilities (per word, times ten at
    most, so that long texts do not all get exactly 1). Null texts and texts without a letter
    are ``und`` with score 0; so is everything if no language was learned.
    Equal sums go to the language first in the alphabet. Columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    text_at = kept.index(text_col)
    passed = [i for i, c in enumerate(kept) if keep_text or c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scores = _Scores(model)
        for b in slices(batches):
            langs, values = [], []
            for text in b.column(text_at).to_pylist():
                words = letter_words(text)
                if not words or not model.langs:
                    langs.append(UNDETERMINED), values.append(0.0)
                    continue
                mean = scores.total(words) / len(words) * min(len(words), 10)
                top = int(np.argmax(mean))
                langs.append(model.langs[top])
                values.append(float(1 / np.exp(mean - mean[top]).sum()))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in passed], pa.array(langs, pa.string()), pa.array(values, pa.float64())], [*[kept[i] for i in passed], "lang_pred", "score"]
            )

    schema = docs.select([kept[i] for i in passed]).withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return docs.select(kept).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id", folds: int = 5):
    """Whether a document is kept from training: crc32 of its id as text, modulo ``folds``, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **limits: int) -> DataFrame:
    """Train on the labelled documents not held out, predict all; adds held_out, lang_pred and score."""
    outs = ("held_out", "lang_pred", "score")
    model = train(docs.where(~held_out(id_col)).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")), **limits)
    kept = docs.select([c for c in docs.columns if c not in outs])
    return predict(kept, model, text_col).withColumn("held_out", held_out(id_col))
