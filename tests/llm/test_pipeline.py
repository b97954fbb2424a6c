import re
from pathlib import Path

import duckdb
import pytest
from helpers import documents, sentence, split, table
from pyspark.sql import functions as F

import corpus_pipeline
from emberfield.llm import queries
from emberfield.llm.decontaminate import normalise

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    import random

    path = str(tmp_path_factory.mktemp("sf"))
    rng = random.Random(8)
    item = sentence(rng, 30)
    rows = documents(n=40) + [(6001, f"{sentence(rng, 60)} {item} {sentence(rng, 60)}", "en", "s", 1)]
    table(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_one_by_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    item = normalise(spark.read.parquet(f"{folder}/benchmark.parquet").first().text)
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        after_df = stage(spark, docs, folder)
        after = [tuple(r) for r in after_df.collect()] if name != "best_fit_packing" else after_df.collect()
        if name != "best_fit_packing":
            assert after_df.columns == docs.columns
        texts = {r[:2]: r for r in before}
        if name == "language_id":
            assert {r[:2] for r in after} == {k for k in texts if any(c.isalpha() for c in k[1] or "")}
            assert len(after) == sum(any(c.isalpha() for c in r[1] or "") for r in before)
        elif name == "ngram_jaccard":
            from test_jaccard import brute

            groups = {(r[0], r[1]): c for r, (_, _, c) in zip(before, brute(before))}
            want = {k for k, c in groups.items() if k[0] is None or c == k[0]}
            assert {r[:2] for r in after} == want and len([r for r in after if r[0] is not None]) == len([k for k in want if k[0] is not None])
        elif name == "substring_dedup":
            from test_substrings import brute as cut

            gone = {(r[0], r[1]): (n, k) for r, (_, n, k, _) in zip(before, cut(before, 50))}
            assert len(after) == sum(not (k and k == n) for n, k in gone.values())
            assert sorted(len(split(r[1])) for r in after) == sorted(n - k for n, k in gone.values() if not (k and k == n))
        elif name == "decontamination":
            leaked = [r for r in before if item in normalise(r[1])]
            assert leaked and {r[:2] for r in after} == {r[:2] for r in before} - {r[:2] for r in leaked}
        else:
            assert {r.doc_id for r in after} == {r[0] for r in before}
        docs = after_df


CLASHING = ["n_words", "leaks", "lang_pred", "score", "component_id", "text_hash", "group", "kept_text", "_text", "_hash", "n_shingles", "removed", "id"]


def test_columns_with_the_operators_names_keep_their_values(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(25)
    for c in CLASHING:
        docs = docs.withColumn(c, F.lit(f"keep {c}"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        assert out.select(CLASHING).distinct().collect() == [tuple(f"keep {c}" for c in CLASHING)]


def test_rows_that_share_an_id_are_judged_by_their_texts(spark, folder):
    import random

    rng = random.Random(2)
    a, b = sentence(rng, 60), sentence(rng, 60)
    near = " ".join(b.split(" ")[:-1] + ["other"])
    rows = [(5, a, "en", "s", 1), (5, b, "en", "s", 1), (3, b, "en", "s", 1), (3, near, "en", "s", 1), (3, a + " and more", "en", "t", 1), (None, b, "en", "s", 1), (9, "", "en", "s", 1), (9, "", "en", "s", 1)]
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, table(spark, rows), folder).collect()]
    of_b = [r for r in got if r[0] == 3 and r[1] in (b, near)]
    assert len(of_b) == 1 and (5, a) not in got and (5, b) not in got
    assert sorted((r[0] is None, r[0] or 0, r[1]) for r in got if r not in of_b) == sorted([(False, 3, a + " and more"), (True, 0, b), (False, 9, "")])


def test_short_clean_texts_stay(spark, folder):
    texts = ["the ring", "water and stone", "le la", "¿ñandú?", "ok"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").unionByName(table(spark, [(90_000 + i, t, ["en", None][i % 2], "s", 1) for i, t in enumerate(texts)]))
    kept = {r.text for r in corpus_pipeline.identify_language(spark, docs, folder).where("doc_id >= 90000").collect()}
    assert kept == set(texts)


def test_run_and_registration(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 0
    numbers = {int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES}
    assert numbers == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    got = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.select(columns).collect()), key=key) == sorted(want.fetchall(), key=key)
