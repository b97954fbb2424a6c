import hashlib
import random

import public_tokenizers
import tiktoken
from helpers import SCHEMA, documents, same_rows, table
from pyspark.sql import functions as F

from emberfield.llm import queries
from emberfield.llm.byte_bpe import PreTokens, decode, encode, read_ranks
from emberfield.llm.dictionaries import Dictionary

NAME = "byte_bpe_50k.tiktoken"
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(NAME), special_tokens={})


def awkward():
    rows = documents()
    rng = random.Random(3)
    parts = list("ab the ing 12.,'\n\n   \t\r▁é日本ñ\x00<>s|\x1c\x85\xa0 　") + ["'s", "'ll", "<|endoftext|>", " don't", "́", "٣", "𐤀", "\U000107bb", "\U00010940", "Ᲊ", "\U0001f600"]
    rows += [(7000 + i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 40))), None, None, None) for i in range(400)]
    rows += [(8000, "ab" * 100_000, "en", "long word", 1), (8001, "x y\n" * 150_000, "en", "long text", 1), (8002, " " * 50_000 + "a", None, None, None)]
    return rows


def test_pretokens_are_the_librarys_for_every_code_point():
    cut = PreTokens()
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(every), 2_000):
        text = "".join(f"a{c} 1{c}{c}" for c in every[at : at + 2_000])
        units = Dictionary()
        codes = cut(text, units)
        words = list(units)
        assert "".join(words[c] for c in codes) == text
        ids = [LIBRARY._encode_single_piece(w.encode()) for w in words]
        assert [i for c in codes.tolist() for i in ids[c]] == LIBRARY.encode_ordinary(text)


def test_round_trip_and_ids(spark):
    rows = awkward()
    got = decode(encode(table(spark, rows, extra=["decoded", "k_0", "ids"]), keep=["doc_id", "k_0", "ids"], block_bytes=1 << 14))
    assert got.columns == ["doc_id", "k_0", "ids", "decoded"]
    same_rows([(r[0], list(r[2]), bytes(r[3])) for r in got.collect()], [(r[0], LIBRARY.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in rows])


def test_empty_tables_and_unknown_ids(spark):
    assert encode(table(spark, [], SCHEMA)).count() == 0
    assert encode(table(spark, [(1, None, None, None, None)]), keep=["doc_id"]).collect() == [(1, [])]
    odd = spark.createDataFrame([(1, [72, 50_300]), (2, None), (3, []), (4, [-1]), (5, [None, 3]), (6, [39, 72])], "doc_id long, ids array<int>")
    by_id = {r: t for t, r in read_ranks(NAME).items()}
    assert [r[2] for r in sorted(decode(odd).collect())] == [None, None, b"", None, None, by_id[39] + by_id[72]]
    assert decode(odd.limit(0)).count() == 0


def test_each_word_is_sent_once_and_blocks_stay(spark):
    docs = table(spark, documents())
    plan = encode(docs, keep=["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 3, plan  # units out, answers back; the blocks are read in their buckets


def test_query(spark, tmp_path):
    rows = awkward()
    table(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op11_byte_bpe"](spark, str(tmp_path)).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for doc_id, text, *_ in rows:
        ids = LIBRARY.encode_ordinary(text or "")
        want.append((doc_id, len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode())))
    same_rows(got, want)
