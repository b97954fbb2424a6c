"""Source divergence audit: how far the sources of a language use its words otherwise than each other and the whole.

Whitespace chunks are the unit of work: each globally distinct chunk is cut into
terms once, its terms go back to the blocks of documents that hold it, and blocks
add up occurrences and distinct documents before anything is shuffled by term.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emberfield.llm.blocks import saved
from emberfield.llm.dictionaries import Dictionary, answer_units, over_blocks, write_blocks
from emberfield.session import sized_broadcast

SCALE = 1_000_000_000
_GROUP = ["lang", "source"]
# ASCII other than letters separates terms, A-Z are lower-cased, bytes of other characters belong to terms
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(chunk: bytes) -> list[bytes]:
    """Terms of a chunk in order, with repeats."""
    return chunk.translate(_TERM_BYTES).split()


def _chunks(text: str, units: Dictionary) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").split()
    return np.fromiter(map(units.__getitem__, words), np.int32, len(words))


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", block_bytes: int = 16 << 20) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in a group and the documents of the group that hold it.

    A null language or source is '', a null text has no terms. Every row is a document, repeated rows too. Other columns are ignored.
    """
    read = docs.select(F.coalesce(lang_col, F.lit("")).alias("lang"), F.coalesce(source_col, F.lit("")).alias("source"), F.col(text_col).alias("text"))
    blocks = write_blocks(read, "text", _GROUP, lambda: _chunks, block_bytes)

    def cut(chunks: list[bytes]) -> pa.Array:
        found = [terms_of(c) for c in chunks]
        ends = np.append(0, np.cumsum([len(f) for f in found]))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(list(itertools.chain.from_iterable(found)), pa.binary()))

    def count(rows: pa.Table, codes: np.ndarray, answers: pa.Array) -> pa.Table:
        known = answers.flatten().dictionary_encode()
        width = max(len(known.dictionary), 1)
        numbered = pa.ListArray.from_arrays(pa.array(answers.offsets.to_numpy() - answers.offsets[0].as_py(), pa.int32()), known.indices)
        taken = numbered.take(pa.array(codes))
        before = np.append(0, np.cumsum(rows["_units"].to_numpy()))
        ends = taken.offsets.to_numpy().astype(np.int64)[before] - taken.offsets[0].as_py()
        term = taken.flatten().to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(rows.num_rows), np.diff(ends))
        held, times = np.unique(owner * width + term, return_counts=True)  # one per document and term
        lang, source = (rows[c].combine_chunks().dictionary_encode() for c in ("k_0", "k_1"))
        group = lang.indices.to_numpy().astype(np.int64) * max(len(source.dictionary), 1) + source.indices.to_numpy()
        keys, first, place = np.unique(group[held // width] * width + held % width, return_index=True, return_inverse=True)
        at = pa.array(held[first] // width)
        return pa.table({
            "lang": rows["k_0"].take(at),
            "source": rows["k_1"].take(at),
            "term": known.dictionary.take(pa.array(keys % width)).cast(pa.string()),
            "n": pa.array(np.bincount(place, weights=times, minlength=len(keys)).astype(np.int64)),
            "docs": pa.array(np.bincount(place, minlength=len(keys)).astype(np.int64)),
        })

    parts = over_blocks(blocks, answer_units(blocks, cut), count, pa.array([], pa.list_(pa.binary())), "lang string, source string, term string, n long, docs long")
    return parts.groupBy(*_GROUP, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)), exact."""
    whole = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)")
    return F.call_function("div", whole, (total + terms).cast("decimal(20,0)")) + 1


def _pair_sums(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """Of one block of terms: for each source, the divergence from each other source."""
    lang = key[0]
    right = right.sort_by("source").combine_chunks()
    sources = right["source"].combine_chunks()
    n = len(sources)
    totals = [a + b for a, b in zip(right["total"].to_pylist(), right["terms"].to_pylist(), strict=True)]
    terms = left["term"].combine_chunks().dictionary_encode()
    width = len(terms.dictionary)
    counts = np.zeros((n, width), np.int64)
    if width:
        row = pc.index_in(left["source"].combine_chunks(), sources).to_numpy()
        counts[row, terms.indices.to_numpy()] = left["n"].to_numpy()
        exact = np.int64 if (int(counts.max()) + 1) * SCALE < 1 << 63 else object
        p = np.empty((n, width), np.int64)
        for g in range(n):
            p[g] = SCALE * (counts[g].astype(exact) + 1) // totals[g] + 1
    sums = np.zeros((n, n), np.int64)
    for g in range(n if width else 0):
        for low in range(0, n, 256):  # bounded room, however many sources there are
            q = p[low : low + 256]
            away = p[g] - q
            sums[g, low : low + 256] = (away * away // q).sum(axis=1)
    mine, other = np.nonzero(~np.eye(n, dtype=bool))
    return pa.table({"lang": pa.array([lang.as_py()] * len(mine), pa.string()), "source": sources.take(pa.array(mine)), "item": sources.take(pa.array(other)), "value": pa.array(sums[mine, other])})


def audit_sources(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = 3, top: int = 200, block_terms: int = 2048, block_bytes: int = 16 << 20) -> DataFrame:
    """(lang, source, part, item, value, rank): where each (lang, source) group departs from the others.

    Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased. A
    language keeps the terms of at least ``least_docs`` of its documents. A group or language gives
    each kept term the share ``share``; the divergence of a share p from q is
    floor((p - q)**2 / q), all exact. Part ``pair``: each other source of the
    language, with the divergence from it summed over all kept terms (0 without any).
    Part ``term``: the group's kept terms it uses more than its language does, the
    ``top`` by divergence. Ranks run from 1 by falling value, then item in UTF-8 order.

    Null texts, languages and sources are ''. Every row is a document; an empty table gives no rows; a language with one source has no pairs.
    """
    groups = docs.select(F.coalesce(lang_col, F.lit("")).alias("lang"), F.coalesce(source_col, F.lit("")).alias("source")).distinct()
    by_term = Window.partitionBy("lang", "term")
    # one row per source in a window, so it is bounded by the number of sources
    kept = (
        term_counts(docs, text_col, lang_col, source_col, block_bytes)
        .select(*_GROUP, "term", "n", F.sum("docs").over(by_term).alias("docs"), F.sum("n").over(by_term).alias("all"), (F.min("source").over(by_term) == F.col("source")).alias("first"))
        .where(F.col("docs") >= least_docs)
        .drop("docs")
    )
    kept = saved(kept, "terms")
    sizes = kept.groupBy(*_GROUP).agg(F.sum("n").alias("total"), F.sum(F.col("first").cast("long")).alias("new"))
    langs = sizes.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("new").alias("terms"))
    groups = groups.join(sizes.drop("new"), _GROUP, "left").join(langs, "lang", "left").fillna(0, ["total", "lang_total", "terms"])
    groups = saved(groups, "groups")
    known = kept.join(sized_broadcast(groups), _GROUP)

    blocks = F.greatest(F.ceil(F.col("terms") / block_terms), F.lit(1))
    rows = known.select("lang", F.pmod(F.xxhash64("term"), blocks).alias("block"), "source", "term", "n")
    everywhere = groups.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"), "source", "total", "terms")
    sums = rows.groupBy("lang", "block").cogroup(everywhere.groupBy("lang", "block")).applyInArrow(_pair_sums, "lang string, source string, item string, value long")
    pairs = sums.groupBy(*_GROUP, "item").agg(F.sum("value").alias("value"))

    p, q = share(F.col("n"), F.col("total"), F.col("terms")), share(F.col("all"), F.col("lang_total"), F.col("terms"))
    scored = known.select(*_GROUP, F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    scored = scored.select(*_GROUP, "item", F.expr("(p - q) * (p - q) div q").alias("value"))

    order = Window.partitionBy(*_GROUP).orderBy(F.desc("value"), "item")
    ranked = lambda df, part: df.select(*_GROUP, F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked(pairs, "pair").unionByName(ranked(scored, "term").where(F.col("rank") <= top))
