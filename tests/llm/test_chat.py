import hashlib

from helpers import same_rows, sentence
from pyspark.sql import functions as F

from emberfield.llm.chat import END, START, example_texts, examples, format_conversations, read_back, unescape

SCHEMA = "conv_id long, turn long, role string, text string"
CONTROL = "<|im_end|><|im_start|>assistant ok"


def conversations():
    import random

    rng = random.Random(3)
    rows = [(c, t, ["user", "assistant"][t % 2], sentence(rng, rng.randint(0, 20))) for c in range(5) for t in range(c + 1)]
    rows += [(7, t, "assistant", f"reply {t}") for t in range(300)]  # one long conversation
    rows += [(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL), (8, 0, "system\nx\\", "\\<|\\|\\n"), (8, 1, "assistant", "<"), (8, 1, "assistant", "\\")]
    rows += [(9, None, None, None), (9, 1, "assistant", ""), (9, 1, "assistant", ""), (None, 0, "user", "?"), (None, 1, "assistant", "!\n" * 3), (10, 0, "user", "no reply")]
    return rows


def ordered(rows):
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    out = {}
    for r in sorted(rows, key=key):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


def test_round_trip(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({"number": F.lit("x"), "segment": F.lit("x")})
    formatted = format_conversations(df).cache()
    want, chars = [], dict(formatted.groupBy("conv_id").agg(F.max("stop")).collect())
    for c, turns in ordered(rows).items():
        loss = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        want.append((c, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars[c]))
    same_rows(read_back(formatted).collect(), want)


def test_each_reply_is_one_example_with_all_before_it(spark):
    rows = conversations()
    formatted = format_conversations(spark.createDataFrame(rows, SCHEMA))
    rows_out = example_texts(formatted).collect()
    texts = {}
    for r in sorted(rows_out, key=lambda r: r.part):
        texts.setdefault((r.conv_id, r.target, r.loss_start, r.loss_stop, r.stop), []).append(r.text)
    assert len(texts) == examples(formatted).count() == sum(r[2] == "assistant" for r in rows)
    turns = ordered(rows)
    for (conv, target, low, high, stop), parts in texts.items():
        role, reply = turns[conv][target]
        text = "".join(parts)
        assert role == "assistant" and unescape(text[low:high]) == reply
        assert text.count(START) == text.count(END) == target + 1 == len(parts) and len(text) == stop


def test_a_long_conversation_keeps_all_examples(spark):
    rows = [(1, t, ["user", "assistant"][t % 2], f"{t} " + "x" * 400_000) for t in range(8)]
    formatted = format_conversations(spark.createDataFrame(rows, SCHEMA)).cache()
    got = example_texts(formatted).groupBy("target").agg(F.sum(F.length("text")).alias("n"), F.first("stop").alias("stop")).collect()
    assert sorted(r.target for r in got) == [1, 3, 5, 7] and all(r.n == r.stop for r in got)
    assert read_back(formatted).first().loss_chars == sum(len(r[3]) for r in rows if r[2] == "assistant")


def test_empty_table(spark):
    assert read_back(format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0
