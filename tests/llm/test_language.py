import random
import zlib
from collections import Counter

import numpy as np
from helpers import SCHEMA, documents, table

from emberfield.llm.language import LanguageModel, _Scores, held_out, identify, letter_words, predict, train, training_rows, word_counts

SYLLABLES = {"en": "the ing th er on and sh ble".split(), "de": "ei sch ung lich ß ä er".split(), "fr": "eau é tre ou ai ê".split()}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus(n=240):
    rng = random.Random(5)
    rows = [(i, prose(rng, lang, rng.randint(5, 60)), lang, "s", 1) for i in range(n) for lang in [rng.choice(list(SYLLABLES))]]
    return rows + [(n, None, "en", None, None), (n + 1, "12 !! ²", "en", "s", 1), (n + 2, "", None, "s", 1), (None, prose(rng, "de", 30), None, None, None), rows[0], rows[0]]


def test_held_out_accuracy_and_rows(spark):
    rows = corpus()
    got = identify(table(spark, rows, extra=["score", "word", "n"])).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
        if r.doc_id in (240, 241, 242):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    held = [r for r in got if r.held_out and r.lang and r.lang_pred != "und"]
    assert held and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_word_counts_and_scores_against_plain_counting(spark):
    rows = [(t, lang) for _, t, lang, *_ in corpus(60) if lang]
    labelled = spark.createDataFrame(rows, "text string, lang string")
    want = Counter((lang, w) for t, lang in rows for w in letter_words(t))
    assert {(r.lang, r.word): r.n for r in word_counts(labelled).collect()} == want
    model = train(labelled)
    vocabulary = {w for _, w in want}
    for i, lang in enumerate(model.langs):
        total = sum(n for (x, _), n in want.items() if x == lang)
        for w in list(vocabulary)[:50]:
            assert abs(model.scores[model.words[w]][i] - np.log((want[lang, w] + 0.5) / (total + 0.5 * len(vocabulary)))) < 1e-4


def test_falls_back_to_shorter_grams():
    model = LanguageModel(["a", "b"], {"known": 0}, [{"abc": 1, "bcd": 2}, {"xy": 3}, {"q": 4}], np.arange(12, dtype=np.float32).reshape(6, 2))
    assert [model.rows(w) for w in ("known", "zabcz", "abcdz", "zxyz", "zqz", "zz")] == [[0], [1], [1, 2], [3], [4], [5]]
    assert _Scores(model).total(["abcdz", "zz", "abcdz"]).tolist() == [2 * 3 + 10, 2 * 4 + 11]


def test_a_sample_bounds_each_language_and_accuracy_holds(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, lang, 40), lang, "s", 1) for i in range(900) for lang in [["en", "de"][i % 2] if i % 10 else "fr"]]
    docs = table(spark, rows)
    labelled = docs.where(~held_out()).select("text", "lang")
    chars = dict(labelled.groupBy("lang").agg({"text": "count"}).collect())
    sample = dict(training_rows(labelled, 20_000).groupBy("lang").agg({"text": "count"}).collect())
    assert sample["fr"] == chars["fr"] and 40 < sample["en"] < chars["en"] / 2
    right = {}
    for bound in (20_000, 1 << 30):
        got = [r for r in identify(docs, lang_chars=bound).collect() if r.held_out]
        right[bound] = sum(r.lang == r.lang_pred for r in got) / len(got)
    assert right[20_000] >= right[1 << 30] - 0.02 and right[20_000] >= 0.97
    model = train(labelled, 20_000)
    assert set(model.words) == {w for r in training_rows(labelled, 20_000).collect() for w in letter_words(r.text)}


def test_very_long_texts_and_words(spark):
    rows = corpus(60)[:60] + [(9000, "sch ei " * 500_000, None, None, 1), (9001, "the" * 1_000_000, None, None, 1), (9002, " ".join(["ungsch"] * 100) + "\n" * 1_000_000, None, None, 1)]
    got = {r.doc_id: r.lang_pred for r in identify(table(spark, rows)).collect()}
    assert (got[9000], got[9001], got[9002]) == ("de", "en", "de")


def test_without_training_rows_all_are_undetermined(spark):
    docs = table(spark, documents())
    model = train(docs.where("false"))
    assert {r.lang_pred for r in predict(docs, model).collect()} == {"und"}
    assert predict(table(spark, [], SCHEMA), model).count() == 0
