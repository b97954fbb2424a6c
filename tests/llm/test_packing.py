import zlib

import numpy as np
import public_tokenizers
from helpers import SCHEMA, documents, table
from tokenizers import Tokenizer

from emberfield.llm.packing import best_fit, pack_documents, pack_lengths, swap_search
from emberfield.llm.tokens import ByteBpe


def test_pieces_and_places(spark):
    rows = documents() + [(9000, "a <|endoftext|> b", None, None, None), (9001, "x" * 5000 + " ՘ ☃", None, None, None)]
    got = pack_documents(table(spark, rows, extra=["piece", "row", "ids"])).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for doc, text, *_ in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        first = (len(ids) - 1) % 1024 + 1
        stops = [0, *range(first, len(ids) + 1, 1024)]
        want += [(doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(stops, stops[1:]))]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got], key=key) == sorted(want, key=key)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:]))
        assert sum(places[-1]) <= 1024
    tokens = sum(r.length for r in got)
    assert len(sequences) <= -(-tokens // 1024) + 1


def test_blocks_meet_in_later_rounds(spark):
    rng = np.random.default_rng(3)
    items = [(i, int(n)) for i, n in enumerate(rng.integers(1, 101, 900))]
    got = pack_lengths(spark.createDataFrame(items, "row long, length long"), 100, block=64).toPandas()
    merged = got.assign(length=[n for r in got.row for n in [items[r][1]]])
    fill = merged.groupby("sequence_id").length.sum()
    assert len(got) == 900 and got.row.is_unique and fill.max() <= 100  # half the items are over half a sequence
    assert len(fill) <= 1.05 * fill.sum() / 100


def test_exchanges_beat_best_fit():
    sizes = np.array([6, 6, 5, 5, 4, 3, 1])  # best fit leaves a fourth bin of ten
    bins = swap_search(best_fit(sizes, 10), sizes, 10)
    assert sorted(i for b in bins for i in b) == list(range(7))
    assert len(bins) == 3


def test_empty_table_and_null_text(spark):
    assert pack_documents(table(spark, [], SCHEMA)).count() == 0
    assert ByteBpe().ids(None) == b""
