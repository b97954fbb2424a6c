import re
from collections import Counter, defaultdict

from helpers import SCHEMA, documents, same_rows, table

from emberfield.llm.divergence import audit_sources, terms_of


def brute(rows, least=3, top=200):
    docs = [(lang or "", source or "", [t.translate({c: c + 32 for c in range(65, 91)}) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for _, text, lang, source, *_ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        held = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = {t for t, n in held.items() if n >= least}
        counts = defaultdict(Counter)
        for of, source, terms in docs:
            if of == lang:
                counts[source].update(t for t in terms if t in kept)
        whole = sum(counts.values(), Counter())
        share = lambda c, t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))
        f = lambda p, q: (p - q) ** 2 // q
        for source, c in counts.items():
            pairs = [(o, sum(f(share(c, t), share(d, t)) for t in kept)) for o, d in counts.items() if o != source]
            terms = [(t, f(share(c, t), share(whole, t))) for t in c if share(c, t) > share(whole, t)]
            for part, items in (("pair", pairs), ("term", terms)):
                order = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, source, part, t, v, i + 1) for i, (t, v) in enumerate(order) if part == "pair" or i < top]
    return out


def rows():
    out = [(i, t, ["en", "fr", None, ""][i % 4 if i else 0] if i else "en", f"s{(i or 0) % 5}" if i and i % 9 else None, n) for i, t, _, _, n in documents() if i is not None]
    out += [(9000 + i, "Été été,ÉTÉ x-ray X\x01y\xa0z 日本,日本 ab12cd", "zz", "αβ"[i % 2], 1) for i in range(6)] + [(9100, "lonely words only here", "one", "s", 1), (9101, None, "none", "a", 1), (9102, "", "none", "b", 1)]
    return out + out[3:5]


def test_against_brute_force(spark):
    for least, top in ((3, 200), (1, 4)):
        df = table(spark, rows(), extra=["term", "n", "item", "value"])
        same_rows(audit_sources(df, least_docs=least, top=top, block_terms=50, block_bytes=2000).collect(), brute(rows(), least, top))


def test_terms():
    assert terms_of("It's,MIXED.Case42é_É".encode()) == ["it".encode(), b"s", b"mixed", b"case", "é".encode(), "É".encode()]


def test_empty_table(spark):
    assert audit_sources(table(spark, [], SCHEMA)).count() == 0
