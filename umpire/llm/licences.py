"""Licence scans: TF-IDF cosine to notice templates, then directory inheritance.

A text's passages (lines; in HTML the stretches between tags) and the text as a
whole are sparse TF-IDF vectors, compared to the templates by cosine.  Inverse
document frequencies count all passages of the table, for all words.  A notice
inside a longer passage is found by windows: as many neighbouring words as a
template has, from each word of that template on.

Neighbouring licences differ in a word or a number that a cosine hardly weighs, so a
template counts only where its marks agree: the names and variant words of licences,
negations, and version numbers.  A text must hold the names that the template holds, the
words around it no others, and the numbers must be the same.  Where two licences are
nearly as near (``MARGIN``), there is no verdict.  So an unknown licence, another version
or a denied one gets no name rather than a neighbour's.

Weights of the templates' words and of words in at least one of ``common``
passages are collected (at most ``common`` times the mean number of distinct
words of a passage).  The weights of all other words are bounded by that, which
leaves few vectors that may be a row's best or reach the threshold; only their
rare words are joined to the table of frequencies.

A row whose best passage reaches the threshold has that licence as its header.
A licence file licenses its directory: a file so named that has a licence, or a text of
``FILE_WORDS`` words or more that reaches the threshold as a whole.  Rows without a header
inherit from the nearest ancestor directory that is licensed: every directory is joined to
its ancestors' paths.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umpire.session import ensure_checkpoint_dir

_GPL = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public "
        "License as published by the Free Software Foundation, either version {version} of the License.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution. {more}This software is provided "
        "by the copyright holders and contributors as is and any express or implied warranties, including, but not limited to, the implied "
        "warranties of merchantability and fitness for a particular purpose are disclaimed.")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted{more}")


def _gnu(name: str, kind: str, version: str) -> tuple[str, ...]:
    return (f"This work is licensed under the GNU {kind}General Public License, version {version}.", _GPL.format(kind=kind, version=version),
            f"SPDX-License-Identifier: {name}")


def _cc(code: str, words: str) -> tuple[str, ...]:
    return (f"Licensed under CC BY{code} 4.0.", f"This work is licensed under a Creative Commons Attribution{words} 4.0 International License.",
            f"SPDX-License-Identifier: CC-BY{code}-4.0")


#: Short notices by licence, in the words that sources use.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License.", "SPDX-License-Identifier: Apache-2.0"),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction.", "SPDX-License-Identifier: MIT"),
    "ISC": ("Licensed under the ISC License.", "SPDX-License-Identifier: ISC",
            _ISC.format(more=", provided that the above copyright notice and this permission notice appear in all copies.")),
    "0BSD": (_ISC.format(more="."), "SPDX-License-Identifier: 0BSD"),
    "GPL-2.0": _gnu("GPL-2.0", "", "2"), "GPL-3.0": _gnu("GPL-3.0", "", "3"),
    "LGPL-2.1": _gnu("LGPL-2.1", "Lesser ", "2.1"), "LGPL-3.0": _gnu("LGPL-3.0", "Lesser ", "3"),
    "AGPL-3.0": _gnu("AGPL-3.0", "Affero ", "3"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0"),
    "CC-BY-NC-4.0": _cc("-NC", "-NonCommercial"), "CC-BY-4.0": _cc("", ""), "CC-BY-SA-4.0": _cc("-SA", "-ShareAlike"),
    "CC-BY-ND-4.0": _cc("-ND", "-NoDerivatives"), "CC-BY-NC-SA-4.0": _cc("-NC-SA", "-NonCommercial-ShareAlike"),
    "CC-BY-NC-ND-4.0": _cc("-NC-ND", "-NonCommercial-NoDerivatives"),
    "CC0-1.0": ("Licensed under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0"),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause", _BSD.format(
        more="Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
             "derived from this software without specific prior written permission. ")),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause", _BSD.format(more="")),
}
#: Names and variant words of licences, and negations; a template that holds
#: none of the names may stand beside those of its family.
NEGATIONS = frozenset("not never neither isn cannot unlicensed".split())
NAMES = frozenset("""0bsd affero agpl apache artistic boost bsd cc cc0 cddl commercial commons creative dual eclipse epl eupl gnu gpl isc lesser
    lgpl library mit mozilla mpl nc nd noncommercial noderivatives noderivs proprietary sa sharealike unlicense zlib""".split()) | NEGATIONS
FAMILY = {"MIT": {"mit"}, "ISC": {"isc"}, "0BSD": {"0bsd"}, "BSD-3-Clause": {"bsd"}, "BSD-2-Clause": {"bsd"}}
MARGIN = 0.95
AROUND = 4
FILE_WORDS = 40
_NUMBER = re.compile(r"[0-9](?:\.[0-9]+)*")
_WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
_TAG = re.compile(r"<[^>]*>")
_FILE = r"(?i)(^|/)(licen[sc]e|copying|notice)([.-][^/]*)?$"


def words(passage: str) -> list[str]:
    return _WORD.findall(passage.lower())


def passages(text: str | None, html: bool) -> list[str]:
    """The non-blank passages of a text; none for a null."""
    if not text:
        return []
    return [p for p in (_TAG.sub("\n", text) if html else text).split("\n") if p.strip()]


def numbers(part: list[str]) -> frozenset[str]:
    """The version numbers of a run of words: below ten, "2.0" the same as "2"."""
    return frozenset(w.removesuffix(".0") for w in part if _NUMBER.fullmatch(w))


class Template:
    """A notice, its words and its marks."""

    def __init__(self, licence: str, notice: str):
        self.licence, self.words = licence, words(notice)
        found = NAMES & set(self.words)
        self.named = bool(found - NEGATIONS)
        # what marks a notice without a name is a clause that its neighbour lacks
        self.required = found if self.named else found & {"neither"}
        self.allowed = found if self.named else found | FAMILY.get(licence, set())
        self.numbers = numbers(self.words) if self.named else None  # clauses may be numbered

    def agrees(self, inside: frozenset, inside_numbers: frozenset, around: frozenset) -> bool:
        return self.required <= inside and around <= self.allowed and (self.numbers is None or self.numbers == inside_numbers)


ALL = [Template(name, notice) for name, notices in TEMPLATES.items() for notice in notices]
VOCABULARY = sorted({w for t in ALL for w in t.words})


class Scorer:
    """Cosines to every template, for given document frequencies."""

    def __init__(self, frequency: dict[str, int], total: int):
        self.weight = {w: math.log((1 + total) / (1 + frequency.get(w, 0))) + 1 for w in {*VOCABULARY, *frequency}}
        self.other = math.log(1 + total) + 1
        self.vectors = []
        for t in ALL:
            vector = {w: n * self.weight[w] for w, n in Counter(t.words).items()}
            norm = math.sqrt(sum(x * x for x in vector.values()))
            self.vectors.append({w: x / norm for w, x in vector.items()})
        self.named = [k for k, t in enumerate(ALL) if t.named]
        self.unnamed: dict[str, list[tuple[int, float]]] = {}
        for k, t in enumerate(ALL):
            for w, y in {} if t.named else self.vectors[k].items():
                self.unnamed.setdefault(w, []).append((k, y))

    def vector(self, bag: Counter, around: Counter | None = None, held: frozenset | None = None) -> Vector:
        """Dot with the nearest template whose marks agree (ties to the first), its licence,
        the squares of the known weights, and the words of unknown weight.

        ``around`` holds the words about a window, ``held`` the numbers up to the word after
        it.  The dot is 0 where no template agrees,
        or where another licence's is nearly as near."""
        inside = NAMES.intersection(bag)
        near = inside if around is None else NAMES.intersection(around)
        values: dict[int, float] = {}
        norm, rare = 0.0, {}
        for w, n in bag.items():
            if (weight := self.weight.get(w)) is None:
                rare[w] = n
                continue
            x = n * weight
            norm += x * x
            for k, y in self.unnamed.get(w, ()):
                values[k] = values.get(k, 0.0) + x * y
        if inside:
            for k in self.named:
                if ALL[k].required <= inside:
                    values[k] = sum(y * bag[w] * self.weight[w] for w, y in self.vectors[k].items() if w in bag)
        best: dict[str, float] = {}
        if values:
            held = numbers(list(bag)) if held is None else held
            for k in sorted(values):
                if ALL[k].agrees(inside, held, near):
                    best[ALL[k].licence] = max(best.get(ALL[k].licence, 0.0), values[k])
        if not best:
            return 0.0, None, norm, rare
        name = max(best, key=best.get)
        if any(v > MARGIN * best[name] for other, v in best.items() if other != name):
            return 0.0, None, norm, rare
        return best[name], name, norm, rare

    def best(self, bag: Counter, around: Counter | None = None, held: frozenset | None = None) -> tuple[float, str | None]:
        """The largest cosine and its licence; words of unknown weight count as unseen."""
        top, name, _, _ = found = self.vector(bag, around, held)
        return (cosine(found, self.other), name) if top > 0 else (0.0, None)

    def windows(self, passage: list[str], bag: Counter, least: float):
        """Vectors of the windows that may reach ``least``.

        A window's cosine to a template is at most the length of the template's
        unit vector on the words that it shares with the passage."""
        shared: dict[int, float] = {}
        for w in bag:
            for k, y in self.unnamed.get(w, ()):
                shared[k] = shared.get(k, 0.0) + y * y
        if held := NAMES.intersection(bag):
            for k in self.named:
                if ALL[k].required <= held:
                    shared[k] = sum(y * y for w, y in self.vectors[k].items() if w in bag)
        for k in sorted(shared):
            size, vector = len(ALL[k].words), self.vectors[k]
            if size >= len(passage) or shared[k] < least * least * (1 - 1e-9):
                continue
            for at in [i for i, w in enumerate(passage) if w in vector]:
                part = passage[at:at + size]
                if sum(vector[w] ** 2 for w in vector.keys() & set(part)) < least * least * (1 - 1e-9):
                    continue
                yield self.vector(Counter(part), Counter(passage[max(0, at - AROUND):at + size + AROUND]), numbers(passage[at:at + size + 1]))


#: dot, licence, squares of known weights, words of unknown weight
Vector = tuple[float, str | None, float, dict[str, int]]


def cosine(vector: Vector, weight: float) -> float:
    """Cosine where all words of unknown weight have this one."""
    dot, _, norm, rare = vector
    return dot / math.sqrt(norm + weight * weight * sum(n * n for n in rare.values())) if dot > 0 else 0.0


def word_counts(rows: DataFrame, text_col: str, html: bool) -> DataFrame:
    """(word, n): passages that hold each word; all passages are the word "".
    One combining aggregate over the whole table."""
    def run(batches):
        seen: Counter = Counter()

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())],
                                              names=["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                for p in passages(text.as_py(), html):
                    seen[""] += 1
                    seen.update(set(words(p)))
                if len(seen) >= 1 << 18:
                    yield batch_of()
                    seen.clear()
        yield batch_of()

    return (rows.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def common_words(counts: DataFrame, common: int) -> tuple[dict[str, int], int, int]:
    """Counts of the templates' words and of all in one of ``common`` passages,
    the number of passages, and the count that all other words are below."""
    total = (counts.filter("word = ''").agg(F.sum("n").alias("n")).first()["n"]) or 0
    least = max(1, -(-total // common))
    found = counts.filter((F.col("word") != "") & ((F.col("n") >= least) | F.col("word").isin(VOCABULARY))).collect()
    return {r["word"]: r["n"] for r in found}, total, least


def document_frequencies(rows: DataFrame, text_col: str, html: bool) -> tuple[dict[str, int], int]:
    """Passages that hold each word of the templates, and all passages."""
    counts = word_counts(rows, text_col, html).filter(F.col("word").isin("", *VOCABULARY)).collect()
    out = {r["word"]: r["n"] for r in counts}
    return out, out.pop("", 0)


def url_path(url: Column) -> Column:
    """Host and path of a URL, without query, fragment and trailing slash."""
    bare = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    return F.regexp_replace(bare, r"/+$", "")


def scan_licences(rows: DataFrame, path: Column, id_col: str = "page_id", text_col: str = "html", html: bool = True,
                  threshold: float = 0.7, common: int = 1000) -> DataFrame:
    """One row per input row: (id, licence, score, origin).

    ``origin`` is "header" (its own notice; ``score`` its cosine), "file" (a
    licence file), "inherited" (``score`` that of the licence file) or null
    where no licence is found (``score`` its own best cosine).  A row's cosine
    is that of its whole text where that makes it a licence file, else of its best
    passage, or of its best window if that reaches the threshold and is more.  ``path`` is a slash-separated expression.  A row
    without a path has no directory.  A null or empty text has cosine 0.  Of
    several licence files in a directory the one of the largest score (to nine places)
    counts, then the first licence by name.  Rows with a null or repeated id each give
    a row; extra columns are ignored.  ``common`` does not change the result.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    counts = word_counts(rows, text_col, html).checkpoint()
    frequency, total, least = common_words(counts, common)
    # a rare word is in 1 to least - 1 passages
    light, heavy = math.log((1 + total) / least) + 1, math.log((1 + total) / 2) + 1
    plain = rows.select(F.col(id_col).alias("id"), path.alias("path"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema[id_col].dataType.simpleString()
    struct = "struct<whole: boolean, dot: double, licence: string, norm: double, rare: array<struct<word: string, n: long>>>"

    def candidates(scorer, text):
        """(whole text?, vector): those that may settle the row."""
        parts, own = Counter(), []
        for passage in map(words, passages(text, html)):
            bag = Counter(passage)
            parts.update(bag)
            found = scorer.vector(bag)
            if found[0] > 0:
                own.append(found)
            own += [w for w in scorer.windows(passage, bag, threshold) if cosine(w, light) >= threshold * (1 - 1e-9)]
        floor = max((cosine(v, heavy) for v in own), default=0.0) * (1 - 1e-9)
        kept, seen = [], set()
        for v in own:
            if cosine(v, light) >= floor and (key := (v[:3], frozenset(v[3].items()))) not in seen:
                seen.add(key)
                kept.append((False, v))
        whole = scorer.vector(parts)
        if sum(parts.values()) >= FILE_WORDS and cosine(whole, light) >= threshold * (1 - 1e-9):
            kept.append((True, whole))
        return kept

    def run(batches):
        scorer = Scorer(frequency, total)
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            found = [[{"whole": w, "dot": v[0], "licence": v[1], "norm": v[2],
                       "rare": [{"word": k, "n": n} for k, n in v[3].items()]} for w, v in candidates(scorer, text.as_py())]
                     for text in batch.column(2)]
            kinds = pa.list_(pa.struct([("whole", pa.bool_()), ("dot", pa.float64()), ("licence", pa.string()), ("norm", pa.float64()),
                                        ("rare", pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())])))]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(range(at, at + batch.num_rows), pa.int64()), pa.array(found, kinds)],
                names=["id", "path", "row", "vectors"])
            at += batch.num_rows

    read = plain.mapInArrow(run, f"id {kind}, path string, row long, vectors array<{struct}>").checkpoint()
    vectors = read.select("row", F.posexplode("vectors").alias("at", "v")).select("row", "at", "v.*")
    # squares are added in one order, whatever the shuffle was
    rare = (vectors.select("row", "at", F.explode("rare").alias("r")).select("row", "at", "r.*").join(counts.select("word", F.col("n").alias("times")), "word")
            .groupBy("row", "at").agg(F.array_sort(F.collect_list(
                F.pow(F.col("n") * (F.log((1 + F.lit(total)) / (1 + F.col("times"))) + 1), 2))).alias("squares")))
    weighed = (vectors.filter(F.size("rare") == 0).select("row", "at", "whole", "dot", "licence", "norm")
               .unionByName(vectors.filter(F.size("rare") > 0).drop("rare").join(rare, ["row", "at"])
                            .withColumn("norm", F.aggregate("squares", F.col("norm"), lambda a, x: a + x)).drop("squares"))
               .withColumn("score", F.col("dot") / F.sqrt("norm")))
    own = F.when(~F.col("whole"), F.struct("score", (-F.col("at")).alias("order"), "licence"))
    best = (weighed.groupBy(F.col("row").alias("of_row"))
            .agg(F.max(own).alias("own"), F.max(F.when(F.col("whole"), F.struct("score", "licence"))).alias("all")))
    by_whole = F.coalesce(F.col("all.score") >= threshold, F.lit(False))
    scored = (read.join(best, F.col("row") == F.col("of_row"), "left")
              .select("id", "path", by_whole.alias("by_whole"),
                      F.when(by_whole, F.col("all.score")).otherwise(F.coalesce("own.score", F.lit(0.0))).alias("score"),
                      F.when(by_whole, F.col("all.licence")).otherwise(F.col("own.licence")).alias("licence"))
              .withColumn("dir", F.when(F.col("path").contains("/"), F.regexp_replace("path", r"/[^/]*$", "")))
              .withColumn("named", F.coalesce(F.col("path").rlike(_FILE), F.lit(False)))
              .withColumn("file", F.col("by_whole") | (F.col("named") & (F.col("score") >= threshold)))
              .checkpoint())
    holders = (scored.filter("file and dir is not null")
               .groupBy(F.col("dir").alias("holder"))
               .agg(F.min(F.struct((-F.round("score", 9)).alias("order"), "licence")).alias("best"))
               .select("holder", F.col("best.licence").alias("dir_licence"), (-F.col("best.order")).alias("dir_score")))
    steps = F.split("dir", "/")
    ancestors = (scored.filter("dir is not null").select("dir").distinct()
                 .select("dir", F.explode(F.sequence(F.lit(1), F.size(steps))).alias("depth"))
                 .select("dir", "depth", F.array_join(F.slice(steps, F.lit(1), F.col("depth")), "/").alias("holder")))
    nearest = (ancestors.join(holders, "holder").groupBy("dir")
               .agg(F.max(F.struct("depth", "dir_licence", "dir_score")).alias("near"))
               .select(F.col("dir").alias("of"), "near.dir_licence", "near.dir_score"))
    out = scored.join(nearest, F.col("dir") == F.col("of"), "left")
    own = F.col("score") >= threshold
    origin = (F.when(F.col("file"), "file").when(own, "header").when(F.col("dir_licence").isNotNull(), "inherited"))
    return out.select(
        F.col("id").alias(id_col), F.when(F.col("file") | own, F.col("licence")).otherwise(F.col("dir_licence")).alias("licence"),
        F.when(~F.col("file") & ~own & F.col("dir_score").isNotNull(), F.col("dir_score")).otherwise(F.col("score")).alias("score"),
        origin.alias("origin"))
