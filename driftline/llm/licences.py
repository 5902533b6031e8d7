"""Licence scan: Dice coefficient over word bigrams against templates.

A document's lines, and its paragraphs of two lines or more, are normalised to words
(runs of letters and digits in lower case) and become sets of word bigrams.  A template
with m bigrams and a text with n can reach a Dice coefficient t only if
t / (2 - t) * m <= n <= (2 - t) / t * m, so these size bounds prune templates before any
bigram is compared.  Of the templates left the one with the largest coefficient counts
(the least name among equals), if it reaches the threshold.

A notice that shares its line or paragraph with other text is found as a window: the
words of a paragraph (or of a line alone) from one bigram of the template to another,
at most (2 - t) / t times as long as the template.  A window reaches t only if it has
t / (2 - t) * m of the template's bigrams, so few templates are searched in a paragraph.
Of overlapping windows of a template the one with the largest coefficient counts, and of
several templates' the one with the most common bigrams; a window inside a
line or paragraph that matches the same licence as a whole is not told again.

Everything happens in a document's own row, with DataFrame functions only and without a
shuffle, in one scan for any number of templates.  Templates come to the driver and are
constants of the expression (8 bytes for each of their bigrams, so a list of some hundred
full licences takes a few MB); a text that shares too few bigrams with all of them together
is left before any template is compared.

Inputs and edge cases: null and empty texts, and those with fewer than two words, match
nothing; repeated rows and ids give repeated matches; null ids are kept; extra columns do
not matter; repeated templates count once, a null licence is named by the empty text; an
empty table or no templates give an empty result.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm.orderhash import _let, _run_starts

THRESHOLD = 0.8

# Usual wordings of licence notices.
NOTICES = [
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd", "Released under the BSD License."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    ("mit-permission", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
     "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
]


# Further wordings, for texts outside the test tables.
VARIANTS = [
    ("apache-2.0", "Released under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache 2.0 License."),
    ("apache-2.0-header", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
     "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
     "for the specific language governing permissions and limitations under the License."),
    ("bsd", "Licensed under the BSD License."),
    ("bsd", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("bsd-conditions", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met:"),
    ("bsd-disclaimer", "This software is provided by the copyright holders and contributors \"as is\" and any express or implied "
     "warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose "
     "are disclaimed."),
    ("cc-by-4.0", "Licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa-4.0", "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
     "provided that the above copyright notice and this permission notice appear in all copies."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "Distributed under the MIT License."),
    ("mit-disclaimer", "The software is provided \"as is\", without warranty of any kind, express or implied, including but not "
     "limited to the warranties of merchantability, fitness for a particular purpose and noninfringement."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


def wider(spark: SparkSession) -> DataFrame:
    """The notices and their variants."""
    return spark.createDataFrame(NOTICES + VARIANTS, "licence string, text string")


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NOTICES, "licence string, text string")


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0)


def bigrams(w: Column) -> Column:
    """The distinct word bigrams, as hashes."""
    pairs = F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i)))
    return F.when(F.size(w) < 2, F.array().cast("array<bigint>")).otherwise(F.array_distinct(pairs))


def _units(text: Column) -> Column:
    """(first line, lines, words) of every line and of every paragraph of more lines."""
    def find(t: Column) -> Column:
        def paragraphs(starts: Column) -> Column:
            def one(d: Column, r: Column) -> Column:
                n = F.coalesce(F.get(starts, r + 1), F.size(t)) - d
                return F.struct(d.alias("line"), n.alias("lines"), F.flatten(F.slice(t, d + 1, n)).alias("words"))
            return F.filter(F.transform(starts, one), lambda u: (u["lines"] > 1) & (F.size(u["words"]) > 0))
        lines = F.transform(t, lambda w, i: F.struct(i.alias("line"), F.lit(1).alias("lines"), w.alias("words")))
        runs = _run_starts(F.size(t), lambda a, b: (F.size(F.get(t, a)) > 0) == (F.size(F.get(t, b)) > 0))
        return F.concat(F.filter(lines, lambda u: F.size(u["words"]) > 1), _let(runs, paragraphs))
    return _let(F.transform(F.split(text, "\n"), words), find)


def _best(known: list[tuple[str, tuple[int, ...]]], threshold: float, unit: Column) -> Column:
    """The best template of one unit, or null."""
    table = F.array(*[F.struct(F.lit(name).alias("licence"), F.lit(len(b)).alias("m"),
                               F.array(*[F.lit(x) for x in b]).alias("bigrams")) for name, b in known])
    least = threshold / (2 - threshold) * min(len(b) for _, b in known)

    every = sorted({x for _, b in known for x in b})

    def compare(b: Column) -> Column:
        n = F.size(b)
        fits = F.filter(table, lambda t: (n >= threshold / (2 - threshold) * t["m"] - 1e-9)
                        & (n <= (2 - threshold) / threshold * t["m"] + 1e-9))
        scored = F.transform(fits, lambda t: F.struct(
            (-2 * F.size(F.array_intersect(b, t["bigrams"])) / (n + t["m"])).alias("less"), t["licence"].alias("licence")))
        first = F.array_min(scored)
        return F.when(-first["less"] >= threshold - 1e-9, F.struct(
            unit["line"].alias("line"), unit["lines"].alias("lines"), first["licence"].alias("licence"), (-first["less"]).alias("dice")))

    def shared(b: Column) -> Column:
        return F.when(F.size(F.filter(b, lambda x: x.isin(every))) >= least - 1e-9, compare(b))

    return F.when(F.size(unit["words"]) - 1 >= least - 1e-9, _let(bigrams(unit["words"]), shared))


def _paragraphs(text: Column) -> Column:
    """(words, line of each word) of every paragraph, also of one line."""
    def find(t: Column) -> Column:
        def one(starts: Column) -> Column:
            def lines(d: Column, r: Column) -> Column:
                own = F.slice(t, d + 1, F.coalesce(F.get(starts, r + 1), F.size(t)) - d)
                return F.struct(F.flatten(own).alias("words"), F.flatten(F.transform(own, lambda w, k: F.array_repeat(d + k, F.size(w)))).alias("at"))
            return F.filter(F.transform(starts, lines), lambda u: F.size(u["words"]) > 1)
        return _let(_run_starts(F.size(t), lambda a, b: (F.size(F.get(t, a)) > 0) == (F.size(F.get(t, b)) > 0)), one)
    return _let(F.transform(F.split(text, "\n"), words), find)


def _apart(found: Column) -> Column:
    """The first of the sorted windows that do not overlap."""
    return F.aggregate(found, F.slice(found, 1, 0), lambda kept, x: F.when(
        F.exists(kept, lambda y: (x["start"] <= y["stop"]) & (y["start"] <= x["stop"])), kept).otherwise(F.concat(kept, F.array(x))))


def _windows(known: list[tuple[str, tuple[int, ...]]], threshold: float, paragraph: Column) -> Column:
    """The best windows of one paragraph that do not overlap."""
    table = F.array(*[F.struct(F.lit(name).alias("licence"), F.lit(len(b)).alias("m"),
                               F.array(*[F.lit(x) for x in b]).alias("bigrams")) for name, b in known])
    share, w = threshold / (2 - threshold), paragraph["words"]
    every = sorted({x for _, b in known for x in b})

    def search(grams: Column, hits: Column) -> Column:
        def template(t: Column) -> Column:
            def starts(own: Column) -> Column:
                need = F.ceil(share * t["m"] - 1e-9).cast("int")

                def window(a: Column, k: Column) -> Column:
                    ends = F.filter(F.slice(own, k + need, F.floor(t["m"] / share + 1e-9).cast("int")),
                                    lambda e: e["i"] - a["i"] < t["m"] / share + 1e-9)

                    def score(e: Column) -> Column:
                        both = F.array_distinct(F.slice(grams, a["i"] + 1, e["i"] - a["i"] + 1))
                        common = F.size(F.array_intersect(both, t["bigrams"]))
                        return F.struct((-2 * common / (F.size(both) + t["m"])).alias("less"), (-common).alias("fewer"),
                                        t["licence"].alias("licence"), a["i"].alias("start"), e["i"].alias("stop"))
                    return F.array_min(F.transform(ends, score))
                reached = F.filter(F.transform(own, window), lambda x: -x["less"] >= threshold - 1e-9)
                return _let(F.sort_array(reached), _apart)
            return _let(F.filter(hits, lambda x: F.array_contains(t["bigrams"], x["h"])), starts)

        near = F.filter(table, lambda t: F.size(F.array_intersect(F.transform(hits, lambda x: x["h"]), t["bigrams"])) >= share * t["m"] - 1e-9)
        found = F.transform(F.flatten(F.transform(near, template)), lambda x: F.struct(
            *[x[c].alias(c) for c in ("fewer", "less", "licence", "start", "stop")]))
        free = _let(F.sort_array(found), _apart)
        return F.transform(free, lambda x: F.struct(
            F.get(paragraph["at"], x["start"]).alias("line"),
            (F.get(paragraph["at"], x["stop"] + 1) - F.get(paragraph["at"], x["start"]) + 1).alias("lines"),
            x["licence"].alias("licence"), (-x["less"]).alias("dice")))

    def hits_of(grams: Column) -> Column:
        hits = F.filter(F.transform(grams, lambda h, i: F.struct(i.alias("i"), h.alias("h"))), lambda x: x["h"].isin(every))
        return _let(hits, lambda x: F.when(F.size(x) > 0, search(grams, x)))

    return _let(F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i))), hits_of)


def _all(known: list[tuple[str, tuple[int, ...]]], threshold: float, text: Column) -> Column:
    """Matches of whole units, and of windows that they do not tell already."""
    units = F.filter(F.transform(_units(text), partial(_best, known, threshold)), lambda x: x.isNotNull())
    parts = F.flatten(F.filter(F.transform(_paragraphs(text), partial(_windows, known, threshold)), lambda x: x.isNotNull()))

    def join(whole: Column) -> Column:
        def told(x: Column) -> Column:
            return F.exists(whole, lambda u: (u["licence"] == x["licence"]) & (u["line"] <= x["line"])
                            & (u["line"] + u["lines"] >= x["line"] + x["lines"]))
        new = F.array_distinct(F.filter(parts, lambda x: ~told(x)))
        return F.concat(whole, new)
    return _let(units, join)


def scan(documents: DataFrame, templates: DataFrame, threshold: float = THRESHOLD,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per matching line, paragraph or window: doc_id, line (from 0), lines, licence, dice."""
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = templates.select("licence", bigrams(words(F.col("text"))).alias("b")).where("size(b) > 0").collect()
    known = sorted({(r["licence"] or "", tuple(sorted(r["b"]))) for r in rows})
    if not known:
        return documents.sparkSession.createDataFrame([], "doc_id long, line int, lines int, licence string, dice double")
    return docs.select("doc_id", F.inline(_all(known, threshold, F.col("text"))))
