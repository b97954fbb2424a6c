import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from emberfield.llm.licences import COMMON, PASSAGES, TEMPLATES, TERM, Weights, _any_word, may_hold, scan_licences, window_scores

SCHEMA = "path string, text string"


def cosine(text):
    vectors = {n: Counter(re.findall(r"[a-z0-9]+(?:\.[0-9]+)*", t.lower())) for n, t in TEMPLATES.items()}
    idf = lambda t: math.log((1 + len(vectors)) / (1 + sum(t in v for v in vectors.values()))) + 1
    unit = lambda c: {t: k * idf(t) / math.sqrt(sum((j * idf(u)) ** 2 for u, j in c.items())) for t, k in c.items()}
    mine = unit(Counter(re.findall(r"[a-z0-9]+(?:\.[0-9]+)*", text.lower())))
    scores = {n: round(sum(w * unit(v).get(t, 0) for t, w in mine.items()), 9) for n, v in vectors.items()}
    best = max(scores.values(), default=0)
    return best, min(n for n, s in scores.items() if s == best)


def brute(rows, threshold=0.8, words=50):
    own, held = [], {}
    for path, text in rows:
        path, text = path or "", text or ""
        directory = path.rpartition("/")[0]
        is_file = bool(re.match(r"(?i)^(licen[cs]e|copying)\b", path.rpartition("/")[2])) or len(re.findall(r"[^\x20\x09-\x0D]+", text)) <= words
        spots = [*text.split("\n"), *([text] if is_file else [])]
        found = max((cosine(s) for s in spots), key=lambda x: x[0])
        found = found if found[0] >= threshold else None
        own.append((path, directory, found))
        if found and is_file:
            held[directory] = min(held.get(directory, (0, "")), (-found[0], found[1]))
    out = []
    for path, directory, found in own:
        if found:
            out.append((path, found[1], found[0], "own", None))
            continue
        parts = directory.split("/") if directory else []
        above = next((d for k in range(len(parts), -1, -1) if (d := "/".join(parts[:k])) in held), None)
        out.append((path, held[above][1], -held[above][0], "inherited", above) if above is not None else (path, None, None, None, None))
    return out


def files():
    prose = "the ring of stone under water lies over light and green " * 12
    return [
        ("a/LICENSE", "Released under the MIT License."),
        ("a/b/x.py", f"{prose}\nlicensed under the apache license, version 2.0\n{prose}"),
        ("a/b/y.py", prose), ("a/b/c/z.py", None), ("a/b/c/COPYING.txt", f"{prose}\nAll rights reserved."), ("a/b/c/d/q", "some words"), ("e/f", prose),
        ("e/g", "This work is licensed under the GNU General Public License, version 3."), ("e/h/i/j", ""), ("e/h/i/j", ""), ("top", prose), (None, None),
        ("k/1", "Licensed under CC BY-NC 4.0."), ("k/2", "Licensed under CC BY 4.0."), ("k/3", prose), ("m/LICENSE", "rights"), ("m/n", "work under the license of water"),
        ("k/4", "This work is licensed under the GNU Lesser General Public License version 3 or so"), ("licence", "nothing here"),
    ]


def test_against_brute_force(spark):
    rows = files()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({"licence": F.lit("x"), "name": F.lit("x"), "similarity": F.lit(1)})
    got = scan_licences(df.withColumnRenamed("path", "where"), F.col("where"), F.col("text")).select("path", "licence", "similarity", "origin", "from_directory")
    key = lambda r: tuple(str(x) for x in r)
    for a, b in zip(sorted(map(tuple, got.collect()), key=key), sorted(brute(rows), key=key), strict=True):
        assert a[:2] == b[:2] and a[3:] == b[3:], (a, b)
        assert (a[2] is None and b[2] is None) or abs(a[2] - b[2]) < 1e-8


PROSE = "the ring of stone under water lies over light and green " * 12
GPL = """{p}This program is free software: you can redistribute it and/or modify
{p}it under the terms of the GNU {k}General Public License as published by
{p}the Free Software Foundation, either version {v} of the License, or
{p}(at your option) any later version."""
MIT = """Copyright (c) 2020 Jane Doe. All rights reserved.

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
BSD = """Copyright (c) 2020, Jane Doe. All rights reserved.
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
3. Neither the name of Jane Doe nor the names of its contributors may be
   used to endorse or promote products derived from this software without
   specific prior written permission."""
PLANTED = [
    ("Copyright (c) 2020 Jane Doe. All rights reserved.", "proprietary"), ("# Copyright 2019 Acme Inc. Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("# MIT License", "MIT"), ("The MIT License (MIT)", "MIT"), (f"{PROSE} It is licensed under the MIT\nLicense. {PROSE}", "MIT"),
    (f"{PROSE}Released under\n * the MIT License. {PROSE}", "MIT"), (f"{PROSE} Licensed under CC BY-NC 4.0. {PROSE}", "CC-BY-NC-4.0"),
    (GPL.format(p="# ", k="", v=3), "GPL-3.0"), (GPL.format(p=" * ", k="", v=2), "GPL-2.0"), (GPL.format(p="", k="Lesser ", v=3), "LGPL-3.0"),
    (f"{PROSE}\n{MIT}\n{PROSE}", "MIT"), (f"{BSD}\n{PROSE}", "BSD-3-Clause"), ("GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc.\n" + PROSE, "GPL-3.0"),
    ("// SPDX-License-Identifier: GPL-2.0-only\n" + PROSE, "GPL-2.0"), ("/* SPDX-License-Identifier: BSD-2-Clause */", "BSD-2-Clause"),
    ("# SPDX-License-Identifier: Apache-2.0 OR MIT\n" + PROSE, "Apache-2.0 OR MIT"), ("SPDX-License-Identifier: (GPL-2.0-or-later WITH Classpath-exception-2.0) AND ISC", "GPL-2.0 WITH Classpath-exception-2.0 AND ISC"),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"), (f"{PROSE} licensed under the GNU Affero General Public License, version 3. {PROSE}", "AGPL-3.0"),
    (GPL.format(p="", k="Affero ", v=3), "AGPL-3.0"), ("it under the terms of the GNU General Public License as published by", None), (GPL.format(p="", k="", v="one"), None),
    ("Use of this source code is governed by the BSD 2-Clause License.", "BSD-2-Clause"), ("Use of this source code is governed by the BSD 3-Clause License.", "BSD-3-Clause"),
    ("Licensed under CC BY-ND 4.0.", None), ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"), ("Licensed under CC BY 3.0.", None), (PROSE + "all rights of the license and reserved software under the general public", None), ("mit", None), (PROSE, None),
]


def test_prefixed_wrapped_and_embedded_statements(spark):
    rows = [(f"{i}/LICENSE", text) for i, (text, _) in enumerate(PLANTED)]
    got = scan_licences(spark.createDataFrame(rows, SCHEMA), F.col("path"), F.col("text")).select("path", "licence", "origin").collect()
    want = [(f"{i}/LICENSE", licence, licence and "own") for i, (_, licence) in enumerate(PLANTED)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_all_names_of_an_expression(spark):
    rows = [("a/LICENSE", "SPDX-License-Identifier: Apache-2.0 OR MIT"), ("a/b", "prose"), ("c/LICENSE", "MIT License"), ("d/x", "nothing")]
    got = scan_licences(spark.createDataFrame(rows, SCHEMA), F.col("path"), F.col("text")).select("path", "licences").collect()
    assert sorted(map(tuple, got)) == [("a/LICENSE", ["Apache-2.0", "MIT"]), ("a/b", ["Apache-2.0", "MIT"]), ("c/LICENSE", ["MIT"]), ("d/x", None)]


def test_very_long_texts(spark):
    header = "Licensed under the Apache License, Version 2.0."
    rows = [("a/1", (PROSE + "\n") * 20_000 + header), ("b/1", PROSE * 20_000 + header), ("c/1", "x" * 3_000_000), ("d/1", "version " * 30_000)]
    got = scan_licences(spark.createDataFrame(rows, SCHEMA), F.col("path"), F.col("text")).select("path", "licence").collect()
    assert sorted(map(tuple, got)) == [("a/1", "Apache-2.0"), ("b/1", "Apache-2.0"), ("c/1", None), ("d/1", None)]


def window_cosines(text, weights, templates, threshold):
    """Every window of every template's number of terms, and which templates it reaches the threshold with."""
    terms, found = re.findall(TERM, text.lower()), {}
    for name, template in templates.items():
        size, v = len(re.findall(TERM, template.lower())), weights.vectors[name]
        must, bars = weights.rules[name]
        for i in range(max(len(terms) - size, 0) + 1):
            c = Counter(terms[i : i + size])
            raw = {t: k * weights.idf.get(t, weights.other) for t, k in c.items()}
            norm = math.sqrt(sum(x * x for x in raw.values())) or 1
            score = round(sum(x * v.get(t, 0) for t, x in raw.items()) / norm, 9)
            told = all(set(m) & set(c) for m in must) and not set(bars) & set(c)
            if score >= threshold and 2 * len(set(c) & set(v)) >= len(v) and told:
                found[name] = max(found.get(name, 0), score)
    return found


def test_windows_against_brute_force(spark):
    rng = random.Random(3)
    for templates in (TEMPLATES, PASSAGES):
        weights = Weights(templates)
        sizes = {n: len(re.findall(TERM, t.lower())) for n, t in templates.items()}
        texts = []
        for _ in range(60):
            words = [rng.choice(PROSE.split()) for _ in range(rng.randint(0, 30))]
            for t in rng.sample(list(templates.values()), 2):
                part = t.split()
                for _ in range(rng.randint(0, 3)):
                    part[rng.randrange(len(part))] = rng.choice(["water", "version", "gnu", "3", "2", "affero", "license"])
                at = rng.randint(0, len(words))
                words[at:at] = part
            texts.append(" ".join(words))
        df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
        terms = F.regexp_extract_all(F.lower("text"), F.lit(f"({TERM})"), F.lit(1))
        for i, found in df.select("i", window_scores(terms, weights, sizes, 0.8)).collect():
            want = window_cosines(texts[i], weights, templates, 0.8)
            assert {x["name"] for x in found} == set(want), texts[i]
            assert all(abs(x["similarity"] - want[x["name"]]) < 1e-8 for x in found)


def test_a_text_let_by_the_gate_may_hold_a_licence(spark):
    weights = [Weights(TEMPLATES), Weights(PASSAGES)]
    rows = [(name, text) for ts in (TEMPLATES, PASSAGES) for name, text in ts.items()]
    rare = sorted({t for w in weights for t in w.idf if t not in COMMON})
    known = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(_any_word(rare)), F.lit(1)))
    got = spark.createDataFrame(rows, "name string, text string").select("name", "text", known.alias("k"), may_hold(known, weights, 0.8).alias("ok")).collect()
    assert all(r.ok and set(r.k) >= set(re.findall(TERM, r.text.lower())) - COMMON for r in got)


def test_triggers_are_needed():
    weights = Weights(TEMPLATES)
    triggers = weights.triggers(0.8)
    for vector in weights.vectors.values():
        assert math.sqrt(sum(w * w for t, w in vector.items() if t not in triggers)) < 0.8


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert scan_licences(df, F.col("path"), F.col("text")).count() == 0
