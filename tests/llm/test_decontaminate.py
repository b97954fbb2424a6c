import random

from helpers import SCHEMA, documents, sentence, table

from emberfield.llm.decontaminate import find_leaks, nearest_end, normalise, unsearched


def distance(pattern, text):
    """Edit distance of the pattern to its nearest substring, by the full table."""
    previous = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        row = [i]
        for j, b in enumerate(text, 1):
            row.append(min(previous[j] + 1, row[j - 1] + 1, previous[j - 1] + (a != b)))
        previous = row
    return min(previous)


def test_bit_parallel_distance():
    rng = random.Random(2)
    for _ in range(500):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 70)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 90)))
        masks = {}
        for i, c in enumerate(p):
            masks[c] = masks.get(c, 0) | 1 << i
        assert nearest_end(masks, len(p), t)[0] == distance(p, t)


def test_against_full_edit_distance(spark):
    rng = random.Random(4)
    items = [(i, sentence(rng, rng.randint(6, 25))) for i in range(12)] + [(50, None), (51, ""), (52, "brief"), (None, sentence(rng, 9)), (53, "Ä ß " * 10)]
    rows = documents(n=20)[:20] + [(7000, None, None, None, None), (7001, "", None, None, None)]
    for k, (_, t) in enumerate(items[:12]):
        chars = list(f"{sentence(rng, 5)} \n {t.upper() if k % 2 else t}\t{sentence(rng, 4)}")
        for _ in range(k):
            at = rng.randrange(len(chars))
            chars[at : at + rng.randint(0, 1)] = rng.choice("xyz")
        rows.append((6000 + k, "".join(chars), None, None, None))
    rows.append((6100, f"{items[0][1]} {items[15][1]} {items[0][1]}", None, None, None))
    want = {}
    for d, t, *_ in rows:
        for i, item in items:
            p = normalise(item)
            if len(p) >= 16:  # shorter ones are tested below
                n = distance(p, normalise(t))
                if n <= int(0.08 * len(p)):
                    want.setdefault(d, set()).add((i, n))
    df = spark.createDataFrame(items, "item_id long, text string")
    for options in ({}, {"block_chars": 300}):
        got = find_leaks(table(spark, rows, extra=["leaks", "item_id"]), df, **options).collect()
        assert len(got) == len(rows)
        assert {r.doc_id: {(x.item_id, x.distance) for x in r.leaks} for r in got if r.leaks} == want
    assert want[6100] == {(0, 0), (None, 0)}


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert find_leaks(table(spark, [], SCHEMA), items).count() == 0
    assert all(r.leaks == [] for r in find_leaks(table(spark, documents(n=5)), items).collect())


def test_short_items_stand_between_word_borders(spark):
    items = spark.createDataFrame([(1, "What is 7 x 8?"), (2, "中国的首都是哪里?"), (3, "seven up"), (4, "no"), (5, None), (6, "日本の首都は東京")], "item_id long, text string")
    texts = ["so what  IS 7 x 8? 56", "他问:中国的首都是哪里?北京", "seven upper", "a seven up, please", "xseven up", "no no no", "what is 7 x 9?", "答えは日本の首都は東京です"]
    got = find_leaks(table(spark, [(i, t, None, None, 1) for i, t in enumerate(texts)]), items).collect()
    assert {r.doc_id: [(x.item_id, x.distance) for x in r.leaks] for r in got if r.leaks} == {0: [(1, 0)], 1: [(2, 0)], 3: [(3, 0)], 7: [(6, 0)]}
    assert sorted(r.item_id for r in unsearched(items).collect()) == [4, 5]


def test_a_very_long_text(spark):
    item = sentence(random.Random(1), 20)
    rows = [(1, "word " * 600_000 + item, None, None, 1), (2, "x" * 3_000_000, None, None, 1)]
    got = find_leaks(table(spark, rows), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert {r.doc_id: len(r.leaks) for r in got} == {1: 1, 2: 0}
