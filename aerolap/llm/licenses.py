"""License scan (operator 2).

A text's units (its lines, its paragraphs between blank lines, and the whole)
are normalised: lower case, everything but letters and digits is a blank. A
unit is compared with license templates by the Dice coefficient over the sets
of word bigrams, ``2 * common / (unit + template)``. Since the coefficient
cannot exceed what the sizes allow, a template is a candidate only if its
size is within ``t / (2 - t)`` and ``(2 - t) / t`` times the unit's, and units
outside the bounds of all templates are dropped before their bigrams are made.

A notice that shares its line or paragraph with other words is found by
windows: every run of as many words as a template has, from a bigram of the
template on, across the lines that belong to no matching unit. A text without
``t / (2 - t)`` of a template's bigrams has neither such a run nor a matching unit
(whose bigrams are all the text's), so only texts that have them are cut into units,
and these are compared with such templates only.

Everything is a DataFrame expression over one row: no shuffle, no Python. The
templates are literals of the plan; their number is a checked bound.

Defined results: a null or empty text matches nothing; units with fewer than
two words have no bigrams and match nothing; of several matches the highest
coefficient wins, then the first unit (a run's unit is the line on which it
begins), then the first template; overlapping runs are one match, and lines that
repeat a line of a matching paragraph belong to it; rows are independent (repeated rows give equal results); an empty table stays empty;
extra columns are not read. Very long texts are read whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.75
MAX_TEMPLATES = 1000

#: Short public license notices: (SPDX-style name, text). Fixed values.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
            "this software and associated documentation files, to deal in the Software without "
            "restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may "
                   "not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under "
                "the terms of the GNU General Public License as published by the Free Software "
                "Foundation, either version 3 of the License, or (at your option) any later "
                "version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are "
                     "met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International "
                  "License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and "
                "related rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under "
                "the terms of the GNU General Public License as published by the Free Software "
                "Foundation; either version 2 of the License, or (at your option) any later "
                "version."),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under "
                 "the terms of the GNU Affero General Public License as published by the Free "
                 "Software Foundation, either version 3 of the License, or (at your option) any "
                 "later version."),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
            "or without fee is hereby granted, provided that the above copyright notice and this "
            "permission notice appear in all copies."),
    ("ISC", "Released under the ISC License."),
    ("EPL-1.0", "Eclipse Public License - v 1.0"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms "
                "of the Eclipse Public License 2.0."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no "
             "event will the authors be held liable for any damages arising from the use of this "
             "software."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                     "International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                     "International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 "
                     "International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
]

#: Stands for a line of a matching unit: a word of no template.
_BARRIER = "\ua66e"


def bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a template, in order."""
    words = re.sub(r"[^\w]|_", " ", text.lower()).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def _words(unit: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(unit), r"[^\p{L}\p{M}\p{N}]+", " "))
    return F.split(plain, " ")


def _pairs(words: Column) -> Column:
    left = F.slice(words, F.lit(1), F.size(words) - 1)
    right = F.slice(words, F.lit(2), F.size(words) - 1)
    return F.array_distinct(F.zip_with(left, right, lambda a, b: F.concat(a, F.lit(" "), b)))


def units(text: Column) -> Column:
    """Lines, then paragraphs if there are several, then the text if it has several lines."""
    lines = F.split(text, "\n")
    paragraphs = F.split(text, r"\n[\x20\x09-\x0D]*\n")
    return F.concat(lines,
                    F.when(F.size(paragraphs) > 1, paragraphs).otherwise(F.array().cast(
                        "array<string>")),
                    F.when(F.size(lines) > 1, F.array(text)).otherwise(F.array().cast(
                        "array<string>")))


def _candidates(text: Column, templates: Column, known: Column, low: float) -> Column:
    """Templates of whose bigrams the text has enough for a unit or a run of its words to match."""
    # a text that begins or ends with a blank has an empty word there, which is in no known bigram
    words = F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+")
    every = F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1),
                       F.slice(words, F.lit(2), F.size(words) - 1),
                       lambda a, b: F.concat(a, F.lit(" "), b))
    some = F.filter(F.array(F.array_intersect(every, known)), lambda h: F.size(h) > 0)
    # a shade less, so that no rounding drops a template
    return F.flatten(F.transform(some, lambda h: F.filter(
        templates, lambda t: F.size(F.array_intersect(t["b"], h)) >= t["n"] * F.lit(low - 1e-9))))


def _runs(text: Column, matches: Column, near: Column, threshold: float) -> Column:
    """Runs of words that match a template of ``near``, outside the matching units."""
    lines = F.split(text, "\n")
    places = F.transform(matches, lambda m: -m["at"])
    # bound to a lambda's variable, so that each is evaluated once
    found = F.array(F.struct(lines.alias("lines"), places.alias("places")))
    found = F.transform(found, lambda c: F.struct(
        c["lines"].alias("lines"), c["places"].alias("places"),
        F.flatten(F.transform(F.filter(units(text), lambda u, i: (i >= F.size(c["lines"]))
                                       & F.array_contains(c["places"], i)),
                              lambda u: F.split(u, "\n"))).alias("inside")))
    words = F.transform(found, lambda c: F.flatten(F.transform(c["lines"], lambda l, i: F.transform(
        F.filter(_words(F.when(F.array_contains(c["places"], i)
                               | F.array_contains(c["inside"], l), F.lit(_BARRIER)).otherwise(l)),
                 lambda w: w != ""),
        lambda w: F.struct(w.alias("w"), i.alias("line"))))))
    pairs = F.transform(F.filter(words, lambda w: F.size(w) > 1), lambda w: F.struct(
        F.zip_with(F.slice(w, F.lit(1), F.size(w) - 1), F.slice(w, F.lit(2), F.size(w) - 1),
                   lambda a, b: F.concat(a["w"], F.lit(" "), b["w"])).alias("b"),
        F.transform(w, lambda a: a["line"]).alias("line")))

    def of(p: Column, t: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(p["b"])),
                          lambda i: F.array_contains(t["b"], F.element_at(p["b"], i)))
        runs = F.transform(starts, lambda i: F.struct(i.alias("i"), F.array_distinct(F.transform(
            F.sequence(i, F.least(i + t["l"] - 1, F.size(p["b"]))),
            lambda j: F.element_at(p["b"], j))).alias("b")))
        return F.transform(runs, lambda r: F.struct(
            (2 * F.size(F.array_intersect(t["b"], r["b"])) / (t["n"] + F.size(r["b"])))
            .alias("dice"),
            (-F.element_at(p["line"], r["i"])).alias("at"), t["t"].alias("t"),
            r["i"].alias("i"), (r["i"] + t["l"]).alias("end")))

    every = F.flatten(F.transform(pairs, lambda p: F.flatten(F.transform(
        near, lambda t: F.filter(of(p, t), lambda r: r["dice"] >= threshold)))))
    return every


def _notices(runs: Column) -> Column:
    """Number of runs, of which overlapping ones count once."""
    ordered = F.array_sort(F.transform(runs, lambda r: F.struct(r["i"], r["end"])))
    return F.aggregate(
        ordered, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda s, r: F.struct(F.greatest(s["end"], r["end"]).alias("end"),
                              (s["n"] + (r["i"] > s["end"]).cast("int")).alias("n")),
        lambda s: s["n"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         threshold: float = THRESHOLD, templates: list[tuple[str, str]] | None = None
         ) -> DataFrame:
    """One row per document: doc_id, license, dice, unit_no, n_matches.

    ``license`` and ``dice`` are null without a match; ``n_matches`` counts
    the units that match some template, and the notices found among other words.
    """
    chosen = [(name, bigrams(t)) for name, t in (TEMPLATES if templates is None else templates)]
    lengths = [len(re.sub(r"[^\w]|_", " ", t.lower()).split()) - 1
               for (_, b), (_, t) in zip(chosen, TEMPLATES if templates is None else templates) if b]
    chosen = [(name, b) for name, b in chosen if b]
    if not 1 <= len(chosen) <= MAX_TEMPLATES:
        raise ValueError(f"1 to {MAX_TEMPLATES} templates of two or more words are needed")
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    sizes = [len(b) for _, b in chosen]
    literal = F.array(*[F.struct(F.lit(-i).alias("t"), F.lit(len(b)).alias("n"),
                                 F.lit(lengths[i]).alias("l"),
                                 F.array(*[F.lit(x) for x in b]).alias("b"))
                        for i, (_, b) in enumerate(chosen)])
    known = F.array(*[F.lit(x) for x in dict.fromkeys(x for _, b in chosen for x in b)])
    names = F.array(*[F.lit(n) for n, _ in chosen])

    split = F.transform(units(F.col("_text")), lambda u, i: F.struct(
        i.alias("at"), _words(u).alias("w")))
    # a unit of n words has at most n - 1 bigrams
    sized = F.filter(split, lambda u: (F.size(u["w"]) > 1)
                     & (F.size(u["w"]) - 1 >= F.lit(low * min(sizes))))
    paired = F.filter(
        F.transform(sized, lambda u: F.struct(u["at"].alias("at"), _pairs(u["w"]).alias("b"))),
        lambda u: F.size(u["b"]) <= F.lit(high * max(sizes)))

    def best(u: Column) -> Column:
        n = F.size(u["b"])
        near = F.filter(F.col("_near"), lambda t: (t["n"] >= n * F.lit(low))
                        & (t["n"] <= n * F.lit(high)))
        scored = F.transform(near, lambda t: F.struct(
            (2 * F.size(F.array_intersect(t["b"], u["b"])) / (t["n"] + n)).alias("dice"),
            (-u["at"]).alias("at"), t["t"].alias("t")))
        return F.array_max(scored)

    matches = F.filter(F.transform(paired, best), lambda m: m["dice"] >= threshold)
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"),
                       _candidates(text, literal, known, low).alias("_near"))
    rows = rows.select("doc_id", "_text", "_near",
                       F.when(F.size("_near") > 0, matches).alias("_m"))
    rows = rows.select("doc_id", "_m", F.when(F.size("_near") > 0, _runs(
        F.col("_text"), F.col("_m"), F.col("_near"), threshold)).alias("_runs"))
    whole = F.transform("_runs", lambda r: F.struct(r["dice"], r["at"], r["t"]))
    rows = rows.select(
        "doc_id", F.when(F.size("_runs") > 0, F.concat("_m", whole)).otherwise(F.col("_m"))
        .alias("_all"),
        (F.size("_m") + F.coalesce(_notices(F.col("_runs")), F.lit(0))).alias("_n"))
    some = F.size("_all") > 0
    return rows.select("doc_id", "_all", F.array_max("_all").alias("_top"), "_n").select(
        "doc_id", F.when(some, F.element_at(names, 1 - F.col("_top.t"))).alias("license"),
        F.when(some, F.col("_top.dice")).alias("dice"),
        F.when(some, -F.col("_top.at")).alias("unit_no"),
        F.coalesce("_n", F.lit(0)).alias("n_matches"))
