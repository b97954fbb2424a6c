import hashlib

import pytest
from helpers import SCHEMA, documents, same_rows, split, table

from emberfield.llm.substrings import remove_repeated


def brute(rows, size):
    first = {}
    for doc, text, *_ in rows:
        words = split(text)
        for i in range(len(words) - size + 1):
            w = tuple(words[i : i + size])
            if doc is not None:
                first[w] = min(first.get(w, doc), doc)
    out = []
    for doc, text, *_ in rows:
        words = split(text)
        gone = set()
        for i in range(len(words) - size + 1):
            if doc is not None and first[tuple(words[i : i + size])] < doc:
                gone |= set(range(i, i + size))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("size,chunk", [(50, 1 << 24), (7, 3000)])
def test_against_brute_force(spark, size, chunk):
    rows = documents()
    got = remove_repeated(table(spark, rows, extra=["chunk", "rows", "n_removed", "bucket"]), size=size, chunk_bytes=chunk, bucket_words=500)
    assert "lang" in got.columns and "bucket" in got.columns
    found = got.select("doc_id", "n_words", "n_removed", "kept_sha256", "removed", "kept_text").collect()
    same_rows([r[:4] for r in found], brute(rows, size))
    for r in found:
        assert sum(s.stop - s.start for s in r.removed) == r.n_removed
        assert all(a.stop < b.start for a, b in zip(r.removed, r.removed[1:]))  # maximal
        if r.n_removed:
            assert len(split(r.kept_text)) == r.n_words - r.n_removed


def test_empty_table(spark):
    assert remove_repeated(table(spark, [], SCHEMA)).count() == 0
