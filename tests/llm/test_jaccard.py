import random

import pytest
from helpers import SCHEMA, documents, same_rows, sentence, split, table

from emberfield.llm.components import components
from emberfield.llm.jaccard import similar_groups

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, size=5):
    w = split((text or "").translate(LOWER))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows):
    sets = [(d, grams(t)) for d, t, *_ in rows]
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (a, x) in enumerate(sets):
        for j, (b, y) in enumerate(sets[:i]):
            n = len(x & y)
            if None not in (a, b) and n and 100 * n >= 80 * (len(x) + len(y) - n):
                up[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            low[root(i)] = min(d, low.get(root(i), d))
    return [(d, len(s), None if d is None else low[root(i)]) for i, (d, s) in enumerate(sets)]


def near_copies(seed):
    """One large group of near copies, chains that only link step by step, and unlinked texts sharing half."""
    rng = random.Random(seed)
    base = sentence(rng, 120).split(" ")
    rows = [(i, t, None, None, None) for i, t in enumerate(sentence(rng, 60) for _ in range(8))]
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(1, 3)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10_000)}"
        rows.append((100 + i, " ".join(words), None, None, None))
    chain = [f"c{i}" for i in range(70)]
    for i in range(12):
        rows.append((300 - i, " ".join(chain[i * 2 : i * 2 + 40]), None, None, None))
    for i in range(20):
        rows.append((400 + i, " ".join(base[:60]) + " " + sentence(rng, 50), None, None, None))
    return rows


def at_the_edge():
    """The smallest overlap a link allows, in a group whose sizes surround the linked set's."""
    w = lambda letter, first, last: [f"{letter}{i}" for i in range(first, last + 1)]
    texts = {
        "a": w("p", 1, 48) + ["a1"], "b": w("p", 1, 48) + w("x", 1, 10), "c": w("p", 1, 48) + w("x", 1, 11), "d": w("p", 2, 48) + w("x", 1, 10),
        "o1": w("p", 1, 47) + w("o", 1, 60), "o2": w("p", 1, 47) + w("o", 1, 59) + ["z"],
    }
    return [(i, " ".join(t), None, None, None) for i, t in enumerate(texts.values())]


def mixed_sizes(seed):
    """Groups of mixed sizes around texts that share just as many grams with one member as a link needs."""
    rng = random.Random(seed)
    rows = []
    for g in range(25):
        n = rng.randint(20, 60)
        m = rng.randint(n, n * 5 // 4)
        shared = -(-4 * (n + m) // 9)
        core = [f"g{g}p{i}" for i in range(shared + 4)]
        tail = [f"g{g}x{i}" for i in range(m - shared)]
        texts = [core + [f"g{g}a{i}" for i in range(n - shared)], core + tail, core + tail + [f"g{g}y"], core[1:] + tail]
        texts += [core[:-1] + [f"g{g}o{i}" for i in range(60 - j)] + [f"g{g}z{j}"] * j for j in (0, 1)]
        rows += [(g * 10 + i, " ".join(t), None, None, None) for i, t in enumerate(texts)]
    return rows


@pytest.mark.parametrize("rows,options", [
    (documents(), {}),
    (near_copies(1), {"block": 4, "unit_bytes": 3000, "few_labels": 64, "chunk_bytes": 4000, "bucket_words": 300}),
    (near_copies(2), {"block": 3, "few_labels": 1}),
    (at_the_edge(), {}),
    (mixed_sizes(3), {}),
])
def test_against_brute_force(spark, rows, options):
    got = similar_groups(table(spark, rows, extra=["id", "n", "grams", "component_id"]), **options).select("doc_id", "n_shingles", "component_id")
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    same_rows(got.collect(), brute(rows))


def test_empty_table(spark):
    assert similar_groups(table(spark, [], SCHEMA)).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (500, 300), (300, 400)]
    want = [(i, 0) for i in range(41)] + [(i, 100) for i in range(100, 140)] + [(i, 300) for i in (300, 400, 500)]
    same_rows(components(spark.createDataFrame(edges, "a long, b long")).collect(), want)
