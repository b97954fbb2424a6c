"""Small awkward tables and brute-force versions of the operators."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BLANKS = " \t\n\v\f\r"
WORDS = "the of and ring stone water light under over green river mountain cold quick brown fox jumps lazy dog sleeps near old house tall tree".split()


def split(text):
    out, word = [], ""
    for c in text or "":
        if c in BLANKS:
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out + ([word] if word else [])


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing"]) for _ in range(n))


def documents(seed=1, n=60):
    """Prose with copies, near copies, shared passages, blanks, nulls, an outlier and a repeated row."""
    rng = random.Random(seed)
    passage = sentence(rng, 80)
    rows = []
    for i in range(n):
        text = sentence(rng, rng.randint(3, 160))
        if i % 7 == 3 and rows:
            text = rng.choice(rows)[1]
        elif i % 7 == 4:
            words = rng.choice(rows)[1].split(" ")
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        elif i % 7 == 5:
            text = f"{text}\n{passage} {sentence(rng, 10)}"
        rows.append((i * 3 % n + 1000 * (i % 2), text, ["en", "fr", None][i % 3], "src", len(text)))
    big = sentence(rng, 9000)
    rows += [(5000, None, None, None, None), (5001, "", "en", "", 0), (5002, " \n\t ", "en", "x", 4), (5003, big, "en", "x", 1), (5004, big, "en", "x", 1), (5005, "two words", "en", "x", 9), (5006, "Two Words", "en", "x", 9)]
    rows += [(None, passage, "en", None, 1), (None, None, None, None, None), rows[5], rows[5], (-7, "¿ñandú?\x0b é 日本", None, "s", 3), (5007, "!!! ... 123", None, "s", 1)]
    return rows


def table(spark, rows, schema=SCHEMA, extra=()):
    df = spark.createDataFrame(rows, schema).repartition(3)
    from pyspark.sql import functions as F

    for name in extra:
        df = df.withColumn(name, F.lit("clash"))
    return df


def same_rows(got, want):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)
