"""Byte-level BPE: encoding by a global shuffle of distinct words, decoding by the token-byte table."""

from __future__ import annotations

import base64
import itertools
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberfield.llm.blocks import slices
from emberfield.llm.dictionaries import Dictionary, answer_units, over_blocks, write_blocks


def read_ranks(vocabulary: str) -> dict[bytes, int]:
    with open(public_tokenizers.path(vocabulary), "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@cache
def _library(vocabulary: str) -> tiktoken.Encoding:
    """The library without a pattern of its own: it gets single words."""
    return tiktoken.Encoding(vocabulary, pat_str=r"(?s).+", mergeable_ranks=read_ranks(vocabulary), special_tokens={})


@cache
def _stand_ins() -> dict[int, str]:
    """Characters that the library's Unicode tables class otherwise than ``regex`` does, with one that both class as the library does.

    Both are asked for the class of every code point. The stand-ins are in no contraction of the pattern.
    """
    every = "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, 0x110000))))
    single = {bytes([i]): i for i in range(256)}
    out = {}
    kinds = {r"\p{L}": "x", r"\p{N}": "0", r"\s": "\t"}
    theirs = {k: set(bytes(tiktoken.Encoding("class", pat_str=k, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)).decode()) for k in kinds}
    for kind, stand_in in kinds.items():
        for c in theirs[kind] ^ set(regex.findall(kind, every)):
            if c in theirs[kind]:
                out[ord(c)] = stand_in
            else:
                out.setdefault(ord(c), "!")
    return out


class PreTokens:
    """Matches of the pattern as the library finds them, by way of segments that are cut once per block.

    A space between two visible characters always begins a match, so a text may be
    cut before it and equal segments have equal matches.
    """

    _cut = re.compile(r"(?<=\S) (?=\S)")

    def __init__(self, pattern: str = public_tokenizers.PATTERN):
        self._find = regex.compile(pattern)
        self._stand_ins = _stand_ins()
        self._odd = frozenset(map(chr, self._stand_ins))

    def of(self, text: str) -> list[str]:
        if text.isascii() or self._odd.isdisjoint(text):
            return self._find.findall(text)
        return [text[m.start() : m.end()] for m in self._find.finditer(text.translate(self._stand_ins))]

    def __call__(self, text: str, units: Dictionary) -> np.ndarray:
        first, *rest = self._cut.split(text)
        known, parts = units.parts, [[units[u] for u in self.of(first)]]
        for segment in rest:
            codes = known.get(segment)
            if codes is None:
                codes = known[segment] = [units[u] for u in self.of(" " + segment)]
            parts.append(codes)
        return np.fromiter(itertools.chain.from_iterable(parts), np.int32)


def encode(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, vocabulary: str = "byte_bpe_50k.tiktoken", block_bytes: int = 16 << 20) -> DataFrame:
    """The columns ``keep`` (all but the text by default) and ``ids`` array<int>, the token ids of each whole text.

    Every text is taken apart into its pre-tokens with their positions, in blocks of
    documents that name each distinct pre-token once. Pre-tokens are shuffled by their
    bytes, each distinct one of the whole table is encoded once, and its ids go back to
    the blocks, where they are put together by position. Ids are those the library
    gives, without special tokens; special strings in texts are ordinary text. Null and
    empty texts have no ids. Repeated rows are encoded as often as they occur. A kept column named ``ids`` is replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("ids", text_col)]
    blocks = write_blocks(docs, text_col, keep, PreTokens, block_bytes)

    def ids_of(words: list[bytes]) -> pa.Array:
        encode_one = _library(vocabulary)._encode_single_piece
        return pa.array([encode_one(w) for w in words], pa.list_(pa.int32()))

    def put_together(rows: pa.Table, codes: np.ndarray, answers: pa.Array) -> pa.Table:
        ends = np.append(0, np.cumsum(rows["_units"].to_numpy()))
        tokens = answers.take(pa.array(codes))
        ids = pa.ListArray.from_arrays(pa.array(tokens.offsets.to_numpy()[ends] - tokens.offsets[0].as_py(), pa.int32()), tokens.flatten())
        return rows.drop_columns(["_units"]).append_column("ids", ids)

    schema = T.StructType([T.StructField(f"k_{i}", docs.schema[c].dataType) for i, c in enumerate(keep)] + [T.StructField("ids", T.ArrayType(T.IntegerType()))])
    out = over_blocks(blocks, answer_units(blocks, ids_of), put_together, pa.array([], pa.list_(pa.int32())), schema)
    return out.select(*[F.col(f"k_{i}").alias(c) for i, c in enumerate(keep)], "ids")


def decode(encoded: DataFrame, ids_col: str = "ids", vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """``encoded`` with ``decoded`` binary: the bytes of each row's tokens, joined from the token-byte table.

    The table is as large as the vocabulary, so it is joined on the map side. Null ids give null, and so does a row with
    a null or an id that is not in the table. An input column named ``decoded`` is replaced.
    """
    ranks = read_ranks(vocabulary)
    size = max(ranks.values()) + 1
    by_id: list[bytes | None] = [None] * size
    for token, rank in ranks.items():
        by_id[rank] = token
    shared = encoded.sparkSession.sparkContext.broadcast(by_id)  # bounded by the vocabulary
    read = encoded.drop("decoded")
    at = read.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(shared.value, pa.binary())
        for b in slices(batches):
            ids = b.column(at)
            flat = ids.flatten()
            inside = np.asarray(flat.fill_null(-1))
            inside = np.where((inside >= 0) & (inside < size), inside, -1)
            tokens = table.take(pa.array(inside, mask=inside < 0))
            ends = np.append(0, np.cumsum(ids.value_lengths().fill_null(0).to_numpy()))
            unknown = np.append(0, np.cumsum(np.asarray(tokens.is_null())))[ends]
            good = (unknown[1:] == unknown[:-1]) & np.asarray(ids.is_valid())
            places = np.frombuffer(tokens.buffers()[1], np.int32, len(tokens) + 1, tokens.offset * 4) if len(tokens) else np.zeros(1, np.int32)
            joined = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(np.ascontiguousarray(places[ends])), tokens.buffers()[2] if len(tokens) else pa.py_buffer(b"")])
            decoded = pa.array(good)
            yield b.append_column("decoded", pc.if_else(decoded, joined, pa.scalar(None, pa.binary())))

    return read.mapInArrow(run, T.StructType([*read.schema.fields, T.StructField("decoded", T.BinaryType())]))
