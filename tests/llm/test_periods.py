import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from helpers import SCHEMA, documents, same_rows, split, table

from emberfield.llm import queries
from emberfield.llm.periods import Extensions, find_runs, periodic_runs


def brute_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted([(s, n, q) for (s, n), q in found.items()], key=lambda r: (r[0], r[2]))


def brute_fold(words, doc_id):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def made_of(rng, letters, n):
    out = []
    while len(out) < n:
        part = [rng.randrange(letters) for _ in range(rng.randint(1, 9))]
        out += part * rng.choice([1, 1, 2, 4, 5, 9])
    return out[:n]


def test_extensions_equal_direct_comparison():
    rng = random.Random(1)
    for n, letters in ((1, 1), (40, 1), (300, 2), (900, 1), (700, 3)):
        symbols = np.array(made_of(rng, letters, n) + [10], np.int64)
        a = np.array([rng.randrange(n) for _ in range(500)])
        b = np.array([rng.randrange(n + 1) for _ in range(500)])
        a, b = a[a != b], b[a != b]
        want = []
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            k = 0
            while max(i, j) + k <= n and symbols[i + k] == symbols[j + k]:
                k += 1
            want.append(k)
        assert Extensions(symbols).of(a, b).tolist() == want


def test_runs_equal_brute_force():
    rng = random.Random(2)
    texts = [made_of(rng, letters, rng.randint(0, 120)) for letters in (1, 2, 3, 6, 50) for _ in range(60)]
    texts += [made_of(rng, 30, 6000), [], [1] * 5, [1] * 6, [1, 2] * 4, [1, 2] * 4 + [1]]
    got = find_runs([np.array(t, np.int64) for t in texts])
    assert [[tuple(r) for r in g.tolist()] for g in got] == [brute_runs(t) for t in texts]
    assert find_runs([]) == [] and find_runs([np.empty(0, np.int64)])[0].shape == (0, 3)


def test_a_long_text():
    rng = random.Random(5)
    passage = [rng.randrange(1000) for _ in range(70_000)]
    text = np.array(passage * 5 + [1001] * 50_000, np.int64)
    assert find_runs([text])[0].tolist() == [[0, 350_000, 70_000], [350_000, 50_000, 1]]


def rows():
    rng = random.Random(4)
    out = documents() + [(9000 + i, " ".join(map(str, made_of(rng, 4, rng.randint(5, 200)))), None, "x\ty", 1) for i in range(150)]
    return out + [(9500, "a " * 30_000, None, None, 1), (9501, "na na na na na na\n\nBatman", None, None, 1), (9502, "é日" * 200_000, None, None, 1)]


def expected(doc_id, text):
    words = brute_fold(split(text), doc_id)
    runs = brute_runs(words) if words != ["a"] * 30_000 else [(0, 30_000, 1)]
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(kept)


def test_query(spark, tmp_path):
    all_rows = [r for r in rows() if r[1] is None or len(split(r[1])) < 2000 or r[0] >= 9500]
    table(spark, all_rows, extra=["runs", "period"]).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()
    same_rows(got, [expected(r[0], r[1]) for r in all_rows])


def test_operator_keeps_columns_and_texts(spark):
    docs = table(spark, [(1, "x y x y x y x y z", None, None, 1), (2, None, None, None, 1)], extra=["best", "other"])
    got = sorted(periodic_runs(docs).collect())
    assert got[0].kept_text == "x y z" and got[0].runs == [(0, 8, 2)] and got[0].best == (0, 8, 2) and got[0].other == "clash"
    assert got[1].runs == [] and got[1].best is None and got[1].kept_text == ""
    assert periodic_runs(table(spark, [], SCHEMA)).count() == 0
