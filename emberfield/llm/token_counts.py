"""Token counts of a SentencePiece BPE with most words counted without merging."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfield.llm.blocks import slices

_SPACE = "▁"  # how the model writes a space


@cache
def _library(model: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))


@cache
def whole_tokens(model: str) -> tuple[str, ...]:
    """Words, written without the space before them, that encode alone as one token.

    Each vocabulary string that starts with a space is encoded by itself; it is
    proved when the library answers with exactly that token. Also proves what cutting a
    text relies on: no vocabulary string holds a space after another character, or a line feed, so no
    merge crosses the start of a word or the end of a line.
    """
    sp = _library(model)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    if any(_SPACE in p.lstrip(_SPACE) or "\n" in p for p in pieces):
        raise ValueError(f"{model} has tokens that cross words or lines")
    spaced = [(i, p[1:]) for i, p in enumerate(pieces) if p.startswith(_SPACE) and len(p) > 1 and p[1] != _SPACE]
    encoded = sp.encode([w for _, w in spaced], num_threads=1)
    return tuple(w for (i, w), ids in zip(spaced, encoded, strict=True) if ids == [i])


class TokenCounts(dict):
    """Number of tokens of a word with the space before it: one for the proved words, else merged once and kept."""

    def __init__(self, model: str, proved: tuple[str, ...], limit: int = 300_000):
        super().__init__()
        self._encode = _library(model).encode
        self.proved, self.limit = dict.fromkeys([*proved, ""], 1), limit  # a space alone is one token
        self.update(self.proved)
        self.after_line: dict[str, int] = {}

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
            self.update(self.proved)
        n = self[word] = len(self._encode(word))
        return n

    def _line_start(self, word: str) -> int:
        """Tokens of a line feed and the word right behind it, without a space."""
        n = self.after_line.get(word)
        if n is None:
            if len(self.after_line) >= self.limit:
                self.after_line.clear()
            n = self.after_line[word] = len(self._encode("\n" + word)) - 1  # the library puts one space token in front
        return n

    def _words(self, line: str) -> int:
        """Tokens of a line that has a space in front of it."""
        words = line.split(" ")
        if "" in words and line:  # runs of spaces stay with the word behind them
            return sum(map(self.__getitem__, (w[1:] for w in re.findall(" +[^ ]*", " " + line))))
        return sum(map(self.__getitem__, words))

    def of(self, text: str | None) -> int:
        if not text:
            return 0
        first, *lines = text.replace(_SPACE, " ").split("\n")
        n = self._words(first) if first else 1
        for line in lines:
            start, gap, rest = line.partition(" ")
            n += self._line_start(start)
            if gap:
                n += self._words(rest) if rest else self[""]
        return n


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = "piece_bpe_32k.model", limit: int = 4096) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit): UTF-8 bytes and tokens of every whole text, as the library counts them.

    Texts are cut at the spaces before words and at line feeds, where merges cannot
    cross. Words proved to be one token count one; only the rest is merged by the
    library. No begin, end or added token is counted; special strings in a text
    are ordinary text. Null is counted as empty: no bytes, no tokens. Other columns are
    ignored; repeated rows are counted repeatedly.
    """
    proved = docs.sparkSession.sparkContext.broadcast(whole_tokens(model))  # bounded by the vocabulary

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = TokenCounts(model, proved.value)
        for b in slices(batches):
            n = [counts.of(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"])

    sized = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col).alias("text"))
    return sized.mapInArrow(count, "id long, n_bytes long, n_tokens long").select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
