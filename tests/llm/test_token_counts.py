import random

import public_tokenizers
import sentencepiece
from helpers import SCHEMA, documents, same_rows, table

from emberfield.llm.token_counts import TokenCounts, count_tokens, whole_tokens

MODEL = "piece_bpe_32k.model"
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))


def test_any_text_counts_like_the_library():
    rng = random.Random(1)
    counts = TokenCounts(MODEL, whole_tokens(MODEL), limit=20_000)
    parts = list("ab the ing 12.,\n\n   \t\r▁▁é日本ñ\x00<>s|") + ["<s>", "</s>", "<0x0A>", " the", "  ", "\n ", "　", "\xa0", "<unk>"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert counts.of(text) == len(LIBRARY.encode(text)), repr(text)


def test_proved_words_are_single_tokens():
    words = whole_tokens(MODEL)
    assert len(words) > 10_000 and all(len(LIBRARY.encode(w)) == 1 for w in words[::97])


def test_table(spark):
    rows = documents()
    got = count_tokens(table(spark, rows, extra=["n_tokens", "id"])).collect()
    same_rows(got, [(d, len((t or "").encode()), n, n > 4096) for d, t, *_ in rows for n in [len(LIBRARY.encode(t or ""))]])
    assert count_tokens(table(spark, [], SCHEMA)).count() == 0
