"""Licence scan: TF-IDF cosine of lines and windows to templates, then inheritance from the nearest directory above."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberfield.llm.blocks import saved

#: Short forms of common licence statements; users pass their own to scan for more.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This file is subject to the terms of the Mozilla Public License, version 2.0.",
    "proprietary": "All rights reserved.",
}
_GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
_CC = {"": "", "-NC": "-NonCommercial", "-SA": "-ShareAlike", "-ND": "-NoDerivatives", "-NC-SA": "-NonCommercial-ShareAlike", "-NC-ND": "-NonCommercial-NoDerivatives"}
#: Longer statements, headers and passages of the whole texts that tell one licence from others. The licence is the key up to the first blank.
PASSAGES = {
    "Apache-2.0 header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "Apache-2.0 text": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "BSD-3-Clause text": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "AGPL-3.0 header": _GNU.format("Affero ", "3"),
    "AGPL-3.0 text": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc.",
    "GPL-2.0 header": _GNU.format("", "2"),
    "GPL-2.0 only": "it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
    "GPL-2.0 text": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc.",
    "GPL-3.0 header": _GNU.format("", "3"),
    "GPL-3.0 text": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc.",
    "LGPL-2.1 header": _GNU.format("Lesser ", "2.1"),
    "LGPL-2.1 text": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc.",
    "LGPL-3.0 header": _GNU.format("Lesser ", "3"),
    "LGPL-3.0 text": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc.",
    "MIT licensed": "licensed under the MIT License",
    "MIT distributed": "distributed under the terms of the MIT License",
    "MIT text": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software',
    "MPL-2.0 header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    **{f"CC-BY{k}-4.0 header": f"This work is licensed under a Creative Commons Attribution{long} 4.0 International License." for k, long in _CC.items()},
    **{f"CC-BY{k}-4.0 text": f"By exercising the Licensed Rights, You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution{long} 4.0 International Public License" for k, long in _CC.items()},
    "AGPL-3.0 licensed": "licensed under the GNU Affero General Public License, version 3",
    "LGPL-2.1 licensed": "licensed under the GNU Lesser General Public License, version 2.1",
    "BSD-2-Clause governed": "Use of this source code is governed by the BSD 2-Clause License.",
}
#: Words that make another licence of the same sentence; each must stand in the text if it is in the template, and must not if it isn't.
QUALIFIERS = (("affero",), ("lesser", "library"), ("nc", "noncommercial"), ("sa", "sharealike"), ("nd", "noderivatives"))
#: A family's name, without which the rest of its statements tells nothing.
FAMILIES = ("gnu", "apache", "mozilla", "bsd", "mit")
#: The line of a file that names its licence exactly.
SPDX = r"(?im)SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+() \t-]*[A-Za-z0-9.+)])"
#: Too short for a cosine: they count where a line has these terms and no other.
TITLES = {
    "Apache-2.0": ("Apache License 2.0", "Apache License, Version 2.0"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License"),
    "GPL-2.0": ("GNU General Public License v2.0", "GNU General Public License, version 2"),
    "GPL-3.0": ("GNU General Public License v3.0", "GNU General Public License, version 3"),
    "MIT": ("MIT License", "The MIT License", "MIT License (MIT)", "The MIT License (MIT)"),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "Mozilla Public License Version 2.0"),
}
#: Stands beside the text of other licences too, so it is the answer only where no other is found.
LAST = "proprietary"
#: Left out first when triggers are chosen: they are in most texts.
COMMON = set("a an and any as at be by can for from in is it its may not of on or that the this to used was with without you work file use copy one if name names products person written specific prior under terms rights free charge".split())
GONE = "0.0"  # in place of a line that is a statement by itself
TERM = r"[a-z0-9]+(?:\.[0-9]+)*"


def _rules(name: str, terms: set[str]) -> tuple[list[list[str]], list[str]]:
    """What tells a template from those like it: of each list one term must stand in the text, and none of the others may."""
    number = re.search(r"\d+(?:\.\d+)?", name.split(" ")[0])
    forms = []
    if number:
        short = number[0].removesuffix(".0")
        forms = [f"{v}{n}" for v in ("", "v") for n in dict.fromkeys((number[0], short, f"{short}.0"))]
    must = [forms] if terms & set(forms) else []
    must += [[f] for f in FAMILIES if f in terms]
    must += [list(q) for q in QUALIFIERS if terms & set(q)]
    return must, [t for q in QUALIFIERS if not terms & set(q) for t in q]


def _told_apart(rules: Column, terms: Column) -> Column:
    return F.forall(rules["must"], lambda one_of: F.arrays_overlap(one_of, terms)) & ~F.arrays_overlap(rules["bars"], terms)


def _rules_of(weights: "Weights", name: str) -> list[Column]:
    must, bars = weights.rules[name]
    lists = [F.array(*[F.lit(t) for t in m]) for m in must]
    return [(F.array(*lists) if lists else F.array().cast("array<array<string>>")).alias("must"), F.array(*[F.lit(t) for t in bars]).alias("bars")]


class Weights:
    """Inverse document frequencies over the templates and their unit vectors."""

    def __init__(self, templates: dict[str, str]):
        counts = {name: Counter(re.findall(TERM, text.lower())) for name, text in templates.items()}
        n = len(counts)
        found = Counter(t for c in counts.values() for t in c)
        self.idf = {t: math.log((1 + n) / (1 + d)) + 1 for t, d in sorted(found.items())}
        self.other = math.log(1 + n) + 1  # a term of no template
        self.rules = {name: _rules(name, set(c)) for name, c in counts.items()}
        self.vectors = {}
        for name, c in counts.items():
            raw = {t: k * self.idf[t] for t, k in c.items()}
            norm = math.sqrt(sum(w * w for w in raw.values()))
            self.vectors[name] = {t: w / norm for t, w in sorted(raw.items())}

    def triggers(self, threshold: float) -> list[str]:
        """Terms of which any text with a cosine of ``threshold`` or more holds one.

        The terms left out of a template weigh less than the threshold together, so
        by themselves they cannot reach it. Frequent terms are left out first.
        """
        return sorted({t for vector in self.vectors.values() for t in self.anchors(vector, threshold)})

    def anchors(self, vector: dict[str, float], threshold: float) -> list[str]:
        """The triggers of one template."""
        room, chosen = threshold * threshold * (1 - 1e-9), []
        for t in sorted(vector, key=lambda t: (t not in COMMON, self.idf[t], len(t), t)):
            room -= vector[t] ** 2
            if room <= 0:
                chosen.append(t)
        return chosen


def best_template(text: Column, weights: Weights) -> Column:
    """Struct (similarity, name) of the template with the largest cosine; ties go to the first name. One whose rules the text breaks counts 0."""
    terms = F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"), F.lit(1))
    idf = F.create_map(*[F.lit(x) for pair in weights.idf.items() for x in pair])
    weigh = lambda all_terms: F.transform(
        F.array_distinct(all_terms),
        lambda t: F.struct(t.alias("t"), (F.size(F.filter(all_terms, lambda u: u == t)) * F.coalesce(F.element_at(idf, t), F.lit(weights.other))).alias("w")),
    )
    zero = F.lit(0.0)
    vectors = F.array(*[
        F.struct(F.lit(name).alias("name"), F.create_map(*[F.lit(x) for pair in v.items() for x in pair]).alias("v"), *_rules_of(weights, name)) for name, v in sorted(weights.vectors.items())
    ])

    def scored(ws: Column) -> Column:
        norm = F.sqrt(F.aggregate(ws, zero, lambda acc, x: acc + x["w"] * x["w"]))
        score = lambda v: F.aggregate(ws, zero, lambda acc, x: acc + x["w"] * F.coalesce(F.element_at(v, x["t"]), zero)) / norm
        told = lambda v: _told_apart(v, F.transform(ws, lambda x: x["t"]))
        return F.transform(vectors, lambda v: F.struct(F.when(told(v), F.round(score(v["v"]), 9)).otherwise(zero).alias("similarity"), v["name"].alias("name")))

    # each step is bound once by a one-element transform
    return F.transform(F.transform(F.array(terms), weigh), lambda ws: _first_best(scored(ws)))[0]


def _first_best(scores: Column) -> Column:
    none = F.struct(F.lit(-1.0).alias("similarity"), F.lit("").alias("name"))
    return F.aggregate(scores, none, lambda best, x: F.when((x["similarity"] > best["similarity"]) | ((x["similarity"] == best["similarity"]) & (x["name"] < best["name"])), x).otherwise(best))


def _let(value: Column, then) -> Column:
    """``then`` of a value that is computed once."""
    return F.transform(F.array(value), then)[0]


def _map(entries: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def window_scores(terms: Column, weights: Weights, sizes: dict[str, int], threshold: float) -> Column:
    """Structs (similarity, name) of the templates that a window of their number of terms reaches ``threshold`` with, each with its best.

    A template is looked for only if the text's distinct terms could reach the threshold, and only in windows that hold
    one of its triggers, and at least half of its distinct terms: one repeated word is no statement. A window's length is first taken from its terms as if none was repeated, which is never too long.
    """
    zero, reach = F.lit(0.0), threshold * (1 - 1e-9)
    idf = _map(weights.idf)
    templates = F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(sizes[name]).alias("size"), _map(v).alias("v"), F.array(*[F.lit(t) for t in weights.anchors(v, threshold)]).alias("anchors"), *_rules_of(weights, name))
        for name, v in sorted(weights.vectors.items())
    ])
    total = lambda xs: F.aggregate(xs, zero, lambda acc, x: acc + x)
    part = lambda x, t: F.coalesce(F.element_at(x["v"], t), zero)

    def exact(x: Column, window: Column, w: Column, shared: Column) -> Column:
        pairs = F.array_distinct(F.arrays_zip(window.alias("t"), w.alias("w"), shared.alias("s")))
        squares = F.transform(pairs, lambda p: F.pow(F.size(F.filter(window, lambda u: u == p["t"])) * p["w"], F.lit(2.0)))
        half = 2 * F.size(F.filter(pairs, lambda p: p["s"] > 0)) >= F.size(x["v"])
        return F.when(half & _told_apart(x, window), F.round(total(shared) / F.sqrt(total(squares)), 9)).otherwise(zero)

    def best(x: Column, terms: Column, w: Column) -> Column:
        n, size = F.size(terms), x["size"]
        at = F.filter(F.transform(terms, lambda t, i: F.when(F.array_contains(x["anchors"], t), i)), lambda i: i.isNotNull())
        starts = F.array_distinct(F.flatten(F.transform(at, lambda a: F.sequence(F.greatest(F.lit(0), a - size + 1), F.least(a, F.greatest(F.lit(0), n - size))))))
        shared = F.transform(terms, lambda t, i: F.get(w, i) * part(x, t))

        def near(shared: Column) -> Column:
            return F.filter(starts, lambda s: total(F.slice(shared, s + 1, size)) >= reach * F.sqrt(F.aggregate(F.slice(w, s + 1, size), zero, lambda acc, y: acc + y * y)))

        return _let(shared, lambda sh: F.array_max(F.transform(near(sh), lambda s: exact(x, F.slice(terms, s + 1, size), F.slice(w, s + 1, size), F.slice(sh, s + 1, size)))))

    def live(known: Column) -> Column:
        return F.filter(templates, lambda x: F.aggregate(known, zero, lambda acc, t: acc + part(x, t) * part(x, t)) >= reach * reach)

    def scored(live: Column, terms: Column) -> Column:
        w = F.transform(terms, lambda t: F.coalesce(F.element_at(idf, t), F.lit(weights.other)))
        found = _let(w, lambda w: F.transform(live, lambda x: F.struct(best(x, terms, w).alias("similarity"), x["name"].alias("name"))))
        return F.when(F.size(live) > 0, F.filter(found, lambda x: x["similarity"] >= threshold)).otherwise(F.array().cast("array<struct<similarity:double,name:string>>"))

    every = F.array(*[F.lit(t) for t in weights.idf])
    return _let(terms, lambda ts: _let(live(F.array_intersect(ts, every)), lambda x: scored(x, ts)))


def _any_word(words: list[str]) -> str:
    """Pattern of any of the words, by their common beginnings, the longest first."""

    def below(rest: list[str]) -> str:
        heads = sorted({w[0] for w in rest if w})
        parts = [re.escape(h) + below([w[1:] for w in rest if w[:1] == h]) for h in heads]
        inner = parts[0] if len(parts) == 1 and "" not in rest else "(?:" + "|".join(parts) + ")" if parts else ""
        return f"{inner}?" if inner and "" in rest else inner

    return r"(?<![a-z0-9])(" + below(words) + r")(?![a-z0-9])"


def may_hold(known: Column, sets: list[Weights], threshold: float) -> Column:
    """Whether a text with these terms, and perhaps all of ``COMMON``, could reach ``threshold`` with a template."""
    templates = []
    for weights in sets:
        for v in weights.vectors.values():
            rare = {t: w * w for t, w in v.items() if t not in COMMON}
            room = sum(w * w for t, w in v.items() if t in COMMON)
            templates.append(F.struct(_map(rare or {"": 0.0}).alias("v"), F.lit(threshold * threshold * (1 - 1e-9) - room).alias("least")))
    zero = F.lit(0.0)
    return F.exists(F.array(*templates), lambda x: F.aggregate(known, zero, lambda acc, t: acc + F.coalesce(F.element_at(x["v"], t), zero)) >= x["least"])


def _title(text: str) -> str:
    return r"(?im)^[^a-z0-9\n]*" + r"[^a-z0-9\n]+".join(re.escape(t) for t in re.findall(TERM, text.lower())) + r"[^a-z0-9\n]*$"


def ancestors(directory: Column) -> Column:
    """The directory and all above it, the nearest first; the top is the empty path."""
    parts = F.split(directory, "/")
    depth = F.when(directory == "", 0).otherwise(F.size(parts))
    return F.transform(F.sequence(depth, F.lit(0), F.lit(-1)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))


def scan_licences(
    files: DataFrame,
    path: Column,
    text: Column,
    templates: dict[str, str] | None = None,
    threshold: float = 0.8,
    file_words: int = 50,
    file_names: str = r"(?i)^(licen[cs]e|copying)\b",
    keep: list[str] | None = None,
    passages: dict[str, str] | None = None,
    titles: dict[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """Licence of every file: its own statement, or that of the nearest directory above.

    Every line of every whole text that can reach ``threshold`` is compared with
    all templates by the cosine of TF-IDF vectors, and so is a licence file as a whole. What is left besides the lines
    that reach it is compared in windows: at every place as many terms as a template or passage has, across line breaks.
    A line that is just a title counts 1. A candidate counts only if the terms that tell licences apart agree: the family's
    name, its version or clause number, and words like affero, lesser, nc, sa and nd. An ``SPDX-License-Identifier`` is read as it
    stands and goes before all else; ``licence`` is then its expression without -only, -or-later and brackets,
    and ``licences`` holds all its names. Else the best one is the file's own, ``LAST`` only without any other.
    Templates given come without the standard passages and titles unless these are given too. A licence file is one named like one, or of at most
    ``file_words`` words; the best of a directory (largest cosine, then first name) holds for all files
    in it and below that have none of their own and no nearer one. Directories are resolved
    among themselves, by joins on their paths, before their files are: a directory
    is one row there, however many files it holds.

    Returns the columns ``keep`` of ``files`` (all by default) plus ``path``, ``licence``, ``licences`` (its names), ``similarity``, ``origin`` (own,
    inherited or null) and ``from_directory``. Null texts have no statement, null paths lie at the top under an empty name; empty tables and
    repeated rows are kept as they are. Input columns with these names are replaced.
    """
    passages = passages or ({} if templates else PASSAGES)
    titles = titles or ({} if templates else TITLES)
    templates = templates or TEMPLATES
    weights = Weights(templates)
    sets = [(weights, templates)] + ([(Weights(passages), passages)] if passages else [])
    one_of = lambda terms: r"(?i)(?<![a-z0-9])(" + "|".join(re.escape(t) for t in terms) + r")(?![a-z0-9])"
    trigger = one_of(weights.triggers(threshold))
    rare = sorted({t for w, _ in sets for t in w.idf if t not in COMMON} | {t for ts in titles.values() for x in ts for t in re.findall(TERM, x.lower()) if t not in COMMON} | {"spdx"})
    outs = ("path", "licence", "licences", "similarity", "origin", "from_directory", "directory")
    read = files.select(*[c for c in (files.columns if keep is None else keep) if c not in outs], F.coalesce(path, F.lit("")).alias("path"), F.coalesce(text, F.lit("")).alias("_text"))
    named = F.element_at(F.split("path", "/"), -1).rlike(file_names)
    short = F.size(F.filter(F.split("_text", r"[\x20\x09-\x0D]+"), lambda w: w != "")) <= file_words
    # the few terms of the templates that a text has tell whether it is looked at more closely
    known = F.array_distinct(F.regexp_extract_all(F.lower("_text"), F.lit(_any_word(rare)), F.lit(1)))
    titled = F.arrays_overlap("_known", F.array(*[F.lit(t) for t in sorted({t for ts in titles.values() for x in ts for t in re.findall(TERM, x.lower()) if t not in COMMON} or {""})]))
    hit = F.col("_hit")
    is_file = hit & (named | short)
    none = F.array().cast("array<struct<similarity:double,name:string>>")
    lines = F.transform(F.split("_text", "\n"), lambda line: F.struct(line.alias("line"), F.when(line.rlike(trigger), best_template(line, weights)).alias("best")))
    reaches = lambda x: F.coalesce(x["best"]["similarity"] >= threshold, F.lit(False))
    whole = F.transform(F.filter("_lines", reaches), lambda x: x["best"])
    rest = F.array_join(F.transform("_lines", lambda x: F.when(reaches(x), F.lit(GONE)).otherwise(x["line"])), "\n")
    terms = F.regexp_extract_all(F.lower(rest), F.lit(f"({TERM})"), F.lit(1))
    counts = [{name: len(re.findall(TERM, t.lower())) for name, t in ts.items()} for _, ts in sets]
    windows = _let(terms, lambda ts: F.concat(*[window_scores(ts, w, c, threshold) for (w, _), c in zip(sets, counts, strict=True)]))
    windows = F.transform(windows, lambda x: F.struct(x["similarity"].alias("similarity"), F.when(x["name"].isin(list(passages)), F.substring_index(x["name"], " ", 1)).otherwise(x["name"]).alias("name")))
    headed = [F.when(F.col("_text").rlike("|".join(_title(t) for t in ts)), F.array(F.struct(F.lit(1.0).alias("similarity"), F.lit(name).alias("name")))).otherwise(none) for name, ts in titles.items()]
    as_file = F.when(F.col("_file") & F.col("_text").rlike(trigger), F.array(best_template(F.col("_text"), weights))).otherwise(none)
    found = F.filter(F.concat(whole, as_file, windows, *headed), lambda x: x["similarity"] >= threshold)
    tag = F.regexp_replace(F.trim(F.regexp_extract("_text", SPDX, 1)), r"-only\b|-or-later\b|\+", "")
    tag = F.regexp_replace(F.regexp_replace(F.regexp_replace(tag, r"(?i)\b(or|and|with)\b", " $1 "), r"[ \t]+", " "), r"[()]", "")
    spdx = F.when(F.array_contains("_known", "spdx") & (tag != ""), F.struct(F.lit(1.0).alias("similarity"), F.trim(tag).alias("name")))
    best = _let(found, lambda xs: _let(_first_best(F.filter(xs, lambda x: x["name"] != LAST)), lambda x: F.when(x["similarity"] >= threshold, x).otherwise(_first_best(xs))))
    owned = (
        read.withColumn("_known", known)
        .withColumn("_hit", (F.size("_known") > 0) & (titled | F.array_contains("_known", "spdx") | may_hold(F.col("_known"), [w for w, _ in sets], threshold)))
        .withColumns({"_lines": F.when(hit, lines), "_file": is_file})
        .withColumn("_best", F.when(hit, F.coalesce(spdx, best)))
        .withColumn("_own", F.when(F.col("_best.similarity") >= threshold, F.col("_best")))
        .withColumn("_dir", F.regexp_replace("path", "(^|/)[^/]*$", ""))
        .drop("_text", "_known", "_hit", "_lines", "_best")
    )
    owned = saved(owned, "licences")
    held = owned.where(F.col("_file") & F.col("_own").isNotNull()).groupBy("_dir", "_own.name").agg(F.max("_own.similarity").alias("s"))
    held = held.groupBy("_dir").agg(F.min(F.struct((-F.col("s")).alias("s"), "name")).alias("_held"))
    nearest = (
        owned.select("_dir").distinct().select("_dir", F.posexplode(ancestors(F.col("_dir"))).alias("_up", "_above"))
        .join(held.withColumnRenamed("_dir", "_above"), "_above")
        .groupBy("_dir").agg(F.min_by(F.struct("_above", "_held"), "_up").alias("_from"))
    )
    nearest = saved(nearest, "directories")
    own = F.col("_own").isNotNull()
    return owned.join(nearest, "_dir", "left").select(
        *[c for c in owned.columns if not c.startswith("_")],
        F.coalesce("_own.name", "_from._held.name").alias("licence"),
        F.filter(F.split(F.regexp_replace(F.coalesce("_own.name", "_from._held.name"), r"(?i) with \S+", ""), r"(?i) (?:or|and) "), lambda x: x != "").alias("licences"),
        F.when(own, F.col("_own.similarity")).otherwise(-F.col("_from._held.s")).alias("similarity"),
        F.when(own, "own").when(F.col("_from").isNotNull(), "inherited").alias("origin"),
        F.when(own, F.lit(None)).otherwise(F.col("_from._above")).alias("from_directory"),
    )
