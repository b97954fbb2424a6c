"""Removal of repeated passages: windows of a fixed number of words."""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberfield.llm.blocks import among, answers, bucket_count, by_id_range, decode_rows, hash_entries, id_bounds, merged, saved, slices
from emberfield.llm.words import Windows, WordHashes, split_words

_OUTPUTS = "n_words long, n_removed long, removed array<struct<start:long,stop:long>>, kept_sha256 string, kept_text string"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _hashed(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word counts per text, window hashes of all texts, and the text number of each window."""
    words, windows = WordHashes(), Windows(size)
    counts, parts = np.zeros(len(texts), np.int64), []
    for i, text in enumerate(texts):
        found = split_words(text)
        counts[i] = len(found)
        if len(found) >= size:
            parts.append(windows.of(words.of(found)))
    hashes = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return counts, hashes, np.repeat(np.arange(len(texts)), np.maximum(counts - size + 1, 0))


def _repeats(ids: np.ndarray, hashes: np.ndarray, owner: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    """Windows that also start in a text with a smaller id: here, or in an earlier chunk."""
    window_id = ids[owner]
    distinct, inverse = np.unique(hashes, return_inverse=True)
    smallest = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(smallest, inverse, window_id)
    return (smallest[inverse] < window_id) | among(distinct, earlier)[inverse]


def _covered(counts: np.ndarray, owner: np.ndarray, repeated: np.ndarray, size: int) -> np.ndarray:
    """Words, numbered through all texts, that lie in a repeated window."""
    first_word = np.cumsum(counts) - counts
    windows = np.maximum(counts - size + 1, 0)
    starts = first_word[owner] + np.arange(len(owner)) - (np.cumsum(windows) - windows)[owner]
    change = np.zeros(int(counts.sum()) + 1, np.int64)
    change[starts[repeated]] += 1  # starts are distinct
    stops = starts[repeated] + size
    change[stops] -= 1
    return np.cumsum(change)[:-1] > 0


def _intervals(mask: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
    return [{"start": a, "stop": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]


def remove_repeated(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 50,
    texts_out: bool = True,
    chunk_bytes: int = 6 << 20,
    bucket_words: int = 750_000,
) -> DataFrame:
    """Mark every word covered by a ``size``-word window that also starts in a text with a smaller id.

    Rabin-Karp hashes of all windows are counted over the whole table: chunks of
    ascending ids send their distinct hashes to buckets, and a bucket answers
    each chunk with the hashes an earlier chunk has too. Repeats inside a chunk
    are found there. Repeated windows are merged into maximal intervals.

    Returns the input's columns plus ``n_words``, ``n_removed``, ``removed``
    (word intervals, stop excluded), ``kept_sha256`` (of the kept words joined by
    one space) and, unless ``texts_out`` is off, ``kept_text`` (the same words; the
    text as it was if nothing goes). An input column with one of these names is
    replaced. Null and empty texts have no words and an empty ``kept_text``.
    Rows with a null id keep all their words and remove none elsewhere. Rows that
    share an id never remove each other's words. Two different windows are taken
    as equal with a chance of about 2**-64 per pair.
    """
    spark = docs.sparkSession
    schema = T.StructType([f for f in T._parse_datatype_string(_OUTPUTS).fields if texts_out or f.name != "kept_text"])
    names = schema.names
    docs = docs.select([c for c in docs.columns if c not in names])
    out_schema = T.StructType([*docs.schema.fields, *schema.fields])
    lengths = saved(docs.select(F.col(id_col).cast("long").alias("id"), (F.octet_length(text_col) + 64).cast("long").alias("n")).fillna(64, ["n"]), "lengths")
    total = lengths.agg(F.sum("n")).first()[0] or 0
    bounds = id_bounds(lengths.where("id is not null"), chunk_bytes)
    chunks = by_id_range(docs, id_col, bounds)
    buckets = bucket_count(spark, total, bucket_words * 6)

    entries = hash_entries(chunks, lambda rows: _hashed(rows[text_col].to_pylist(), size)[1], buckets)

    def seen_before(hashes, chunk, counts):
        return np.append(False, hashes[1:] == hashes[:-1])[: len(hashes)], counts

    replies = answers(entries, seen_before)

    def judged(rows: pa.Table, earlier: np.ndarray | None) -> pa.Table:
        texts = rows[text_col].to_pylist()
        counts, hashes, owner = _hashed(texts, size)
        if earlier is None:
            covered = np.zeros(int(counts.sum()), bool)
        else:
            repeated = _repeats(rows[id_col].to_numpy().astype(np.int64), hashes, owner, earlier)
            covered = _covered(counts, owner, repeated, size)
        del hashes, owner
        out: dict[str, list] = {name: [] for name in names}
        at = 0
        for text, n in zip(texts, counts.tolist(), strict=True):
            mask = covered[at : at + n]
            at += n
            gone = int(mask.sum())
            words = split_words(text)
            left = b" ".join(itertools.compress(words, (~mask).tolist()) if gone else words)
            out["n_words"].append(n)
            out["n_removed"].append(gone)
            out["removed"].append(_intervals(mask) if gone else [])
            out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
            if texts_out:
                out["kept_text"].append(left.decode() if gone else text or "")
        kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "removed": _SPANS, "kept_sha256": pa.string(), "kept_text": pa.string()}
        for name in names:
            rows = rows.append_column(name, pa.array(out[name], kinds[name]))
        return rows

    def finish(key, left, right):
        pa.default_memory_pool().release_unused()
        earlier = merged(right["hashes"].to_pylist())
        return judged(decode_rows(left["rows"].to_pylist()), earlier)

    done = chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(finish, out_schema)

    def untouched(batches):
        for b in slices(batches):
            yield from judged(pa.Table.from_batches([b]), None).combine_chunks().to_batches()

    return done.unionByName(docs.where(F.col(id_col).isNull()).mapInArrow(untouched, out_schema))
