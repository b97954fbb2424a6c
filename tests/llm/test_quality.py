import re

import numpy as np
import pytest
from helpers import SCHEMA, documents, same_rows, table

from emberfield.llm.quality import BASE, DECREASING, FEATURES, features, fit_forest, judge, quality_rules, text_statistics, train_quality


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    repeated = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
    lines = (text or "").split("\n")
    dup = sum(1 for i, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in lines[:i])
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeated)


def test_base_counts_against_brute_force(spark):
    rows = documents(n=30) + [(8000, "a b c a b c a b", None, None, None), (8001, "x\nx\n\n\ny | <b> x\nx \nx \nx", None, None, None), (8002, "a b a b a", None, None, None)]
    got = text_statistics(table(spark, rows, extra=["n_words", "id"])).select("doc_id", *BASE).collect()
    same_rows(got, [(d, *brute(t)) for d, t, *_ in rows])


@pytest.fixture(scope="module")
def forest():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(FEATURES)))
    share = FEATURES.index("symbol_share")
    y = (x[:, share] + 0.3 * np.sin(6 * x[:, 0]) + 0.1 * rng.standard_normal(3000) < 0.5).astype(float)
    signs = np.array([-1 if f in DECREASING else 0 for f in FEATURES])
    return fit_forest(x, y, signs), x, y


def test_forest_learns(forest):
    model, x, y = forest
    assert ((model.predict(x) > 0.5) == y).mean() > 0.9


def test_flat_arrays_equal_walking_the_trees(forest):
    model, x, _ = forest
    for row in x[:20]:
        total = model.bias
        for t in range(len(model.feature)):
            node = 0
            while model.left[t, node] != node:
                node = model.left[t, node] if row[model.feature[t, node]] <= model.threshold[t, node] else model.right[t, node]
            total += model.value[t, node]
        assert abs(model.predict(row[None])[0] - 1 / (1 + np.exp(-total))) < 1e-9


@pytest.mark.parametrize("name", DECREASING)
def test_quality_never_rises_with_constrained_features(forest, name):
    model, x, _ = forest
    part = x[:100].copy()
    last = np.full(100, np.inf)
    for v in np.linspace(0, 1, 40):
        part[:, FEATURES.index(name)] = v
        now = model.predict(part)
        assert (now <= last + 1e-12).all()
        last = now


def test_rules_and_missing_labels(spark):
    docs = table(spark, documents(n=30))
    none = spark.createDataFrame([], "doc_id long, quality int")
    for r in quality_rules(docs, none).collect():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed) and r.quality is None
    assert quality_rules(table(spark, [], SCHEMA), none).count() == 0


def test_trained_verdict(spark):
    good = [(i, " ".join(f"word{i * j % 97}" for j in range(1, 90)), None, None, None) for i in range(1, 60)]
    bad = [(100 + i, " ".join(f"w{i * j % 89} |" for j in range(1, 70)), None, None, None) for i in range(1, 60)]
    labels = spark.createDataFrame([(i, 1) for i in range(1, 60)] + [(100 + i, 0) for i in range(1, 60)] + [(7, None), (None, 1)], "doc_id long, quality int")
    stats = text_statistics(table(spark, good + bad)).cache()
    got = judge(stats, train_quality(stats, labels)).collect()
    assert all(r.kept == (r.doc_id < 100) for r in got if not r.base_failed)
    assert features({c: np.zeros(0) for c in [*BASE, "n_lines", "n_distinct_words", "n_upper", "n_digits", "n_stops"]}).shape == (0, len(FEATURES))
