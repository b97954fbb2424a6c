"""Corpus pipeline: language ID, near-duplicates, repeated passages, benchmark leaks, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberfield.llm import decontaminate, jaccard, language, packing, substrings
from emberfield.llm.blocks import saved
from emberfield.llm.queries import python_path

def _apart(docs: DataFrame, *used: str):
    """``docs`` with all columns but those used under names no operator has, and what gives the result the input's columns again."""
    names = {c: f"column_{i}__" for i, c in enumerate(docs.columns) if c not in used}
    return docs.withColumnsRenamed(names), lambda df: df.select([names.get(c, c) for c in docs.columns]).withColumnsRenamed({v: k for k, v in names.items()})


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter; those without go, as no language was found. A missing ``lang`` is filled in. Input columns keep their values, whatever their names."""
    python_path(spark)
    renamed, back = _apart(docs, "doc_id", "text", "lang")
    model = language.train(renamed.where(~language.held_out()))
    found = language.predict(renamed, model).where(F.col("lang_pred") != language.UNDETERMINED)
    return back(found.withColumn("lang", F.coalesce("lang", "lang_pred")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of similar texts, once; rows without an id stay. Rows that share an id are judged each by its own text; of similar ones the one with the smallest text hash stays."""
    python_path(spark)
    renamed, back = _apart(docs, "doc_id", "text")
    groups = jaccard.similar_groups(renamed).where("doc_id = component_id")
    stay = groups.groupBy("doc_id", F.coalesce("group", "text_hash").alias("_g")).agg(F.min("text_hash").alias("_hash")).select("doc_id", "_hash").distinct()
    known = renamed.where("doc_id is not null").withColumn("_hash", F.xxhash64("text"))
    kept = known.join(stay, ["doc_id", "_hash"], "left_semi").dropDuplicates(["doc_id", "_hash"]).drop("_hash")
    return back(kept.unionByName(renamed.where("doc_id is null")))


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages a document with a smaller id has too; a text of which nothing is left goes. Only ``text`` and ``n_chars`` change, whatever the other columns are called."""
    python_path(spark)
    renamed, back = _apart(docs, "doc_id", "text", "n_chars")
    cut = substrings.remove_repeated(renamed).where("n_removed = 0 or n_removed < n_words")
    changed = F.col("n_removed") > 0
    cut = cut.withColumn("text", F.when(changed, F.col("kept_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return back(cut)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within its error budget. Input columns keep their values, whatever their names."""
    python_path(spark)
    renamed, back = _apart(docs, "doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return back(decontaminate.find_leaks(renamed, items).where(F.size("leaks") == 0))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in training sequences; see ``packing.pack_documents``."""
    python_path(spark)
    return packing.pack_documents(docs, ids_out=False)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard", drop_near_duplicates),
    ("substring_dedup", remove_repeats),
    ("decontamination", drop_leaks),
    ("best_fit_packing", pack),
]
#: SQL can't express the trained model, the edit distance and the exchanges; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table; what a stage returns is written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
