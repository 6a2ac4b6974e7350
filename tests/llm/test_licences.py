import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from umpire.llm import licences as L


def run(spark, rows, **more):
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, path string, html string, licence string")
    return {r["page_id"]: (r["licence"], r["origin"]) for r in L.scan_licences(frame, F.col("path"), html=False, **more).collect()}


def test_headers_files_and_nearest_ancestor(spark):
    apache, mit = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."
    filler = "\n".join(f"some plain prose number {i} about nothing at all" for i in range(30))
    rows = [(1, "h/LICENSE", mit + "\n" + filler), (2, "h/a/b/c.py", filler), (3, "h/a/COPYING.txt", apache + "\n" + filler),
            (4, "h/a/x.py", filler), (5, "h/z.py", filler), (6, "h/a/b/own.py", filler + "\n" + mit), (7, "other/q", filler),
            (8, None, filler), (9, "h/a/n", None), (10, "lone", ""), (11, "m/readme", apache), (12, "m/k/l", "x")]
    assert run(spark, rows) == {
        1: ("MIT", "file"), 2: ("Apache-2.0", "inherited"), 3: ("Apache-2.0", "file"), 4: ("Apache-2.0", "inherited"),
        5: ("MIT", "inherited"), 6: ("MIT", "header"), 7: (None, None), 8: (None, None), 9: ("Apache-2.0", "inherited"),
        10: (None, None), 11: ("Apache-2.0", "header"), 12: (None, None)}
    assert run(spark, []) == {}


def test_cosine_by_hand(spark):
    scorer = L.Scorer({"the": 8, "license": 2}, 9)
    bag = Counter(L.words("the MIT license foreign"))
    weight = {w: math.log(10 / (1 + {"the": 8, "license": 2}.get(w, 0))) + 1 for w in L.VOCABULARY}
    other = math.log(10) + 1
    best = 0
    for n in L.TEMPLATES["MIT"]:  # the only licence whose name the bag holds
        t = {w: c * weight[w] for w, c in Counter(L.words(n)).items()}
        dot = sum(t.get(w, 0) * c * weight.get(w, other) for w, c in bag.items())
        size = math.sqrt(sum(x * x for x in t.values()) * sum((c * weight.get(w, other)) ** 2 for w, c in bag.items()))
        best = max(best, dot / size)
    assert scorer.best(bag) == (pytest.approx(best, abs=1e-12), "MIT") and scorer.best(Counter())[0] == 0


#: One notice per neighbouring licence: its name, or None.
NOTICES = [
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("This work is licensed under the GNU General Public License, version 1.", None),
    ("This work is licensed under the GNU General Public License.", None),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
    ("This work is licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1"),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
    ("SPDX-License-Identifier: GPL-2.0", "GPL-2.0"), ("SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0"), ("SPDX-License-Identifier: GPL-3.0-or-later", "GPL-3.0"),
    ("SPDX-License-Identifier: LGPL-3.0", "LGPL-3.0"), ("SPDX-License-Identifier: LGPL-2.1", "LGPL-2.1"), ("SPDX-License-Identifier: AGPL-3.0", "AGPL-3.0"),
    ("SPDX-License-Identifier: MPL-2.0", "MPL-2.0"), ("SPDX-License-Identifier: MPL-1.1", None), ("SPDX-License-Identifier: ISC", "ISC"),
    ("SPDX-License-Identifier: MIT", "MIT"), ("SPDX-License-Identifier: MIT-0", None), ("SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
    ("SPDX-License-Identifier: Apache-1.1", None), ("SPDX-License-Identifier: Zlib", None), ("SPDX-License-Identifier: EUPL-1.2", None),
    ("SPDX-License-Identifier: BSD-2-Clause", "BSD-2-Clause"), ("SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"), ("SPDX-License-Identifier: BSD-4-Clause", None),
    ("SPDX-License-Identifier: CC-BY-SA-4.0", "CC-BY-SA-4.0"), ("SPDX-License-Identifier: CC-BY-SA-3.0", None), ("SPDX-License-Identifier: CC0-1.0", "CC0-1.0"),
    ("Licensed under the BSD 2-Clause License.", "BSD-2-Clause"), ("Licensed under the BSD 3-Clause License.", "BSD-3-Clause"), ("Licensed under the BSD License.", None),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"), ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"), ("Licensed under CC BY-NC-ND 4.0.", "CC-BY-NC-ND-4.0"),
    ("Licensed under CC BY 3.0.", None),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
    ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "CC-BY-ND-4.0"),
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"), ("Licensed under the Apache License, Version 1.1.", None),
    ("Licensed under the ISC License.", "ISC"), ("Licensed under the Foo License.", None), ("Licensed under the Mozilla Public License, version 2.0.", "MPL-2.0"),
    ("This is not licensed under the MIT License.", None), ("This file was never released under the MIT License.", None),
    ("Copyright 2019 Foo. Released under the MIT License.", "MIT"), ("Licensed under the MIT License or the Apache License, Version 2.0.", None),
    ("some words then a notice: Licensed under CC BY-NC-ND 4.0. and more words after it", "CC-BY-NC-ND-4.0"),
]


def test_neighbouring_licences_get_their_own_name_or_none(spark):
    got = run(spark, [(i, f"d{i}/page", n) for i, (n, _) in enumerate(NOTICES)] + [(1000 + i, f"d{i}/other", "plain prose") for i in range(len(NOTICES))])
    for i, (notice, want) in enumerate(NOTICES):
        assert got[i] == (want, "header" if want else None), notice
        assert got[1000 + i] == (None, None), "one line is no licence file"


def test_whole_texts_are_licence_files(spark):
    def text(licence):
        return L.TEMPLATES[licence][2].replace(". ", ".\n")
    rows = [(1, "a/x.md", "BSD License\nCopyright (c) 2020 Foo\n" + text("BSD-3-Clause")), (2, "b/x.md", "Copyright Foo\n" + text("BSD-2-Clause")),
            (3, "a/y", "plain"), (4, "b/y", "plain"), (5, "c/LICENSE", "MIT License\n" + text("MIT")), (6, "c/y", "plain"), (7, "d/COPYING", "see the web"), (8, "d/y", "plain"),
            (9, "e/LICENSE", text("ISC")), (10, "f/LICENSE", L.TEMPLATES["0BSD"][0])]
    assert run(spark, rows) == {1: ("BSD-3-Clause", "file"), 2: ("BSD-2-Clause", "file"), 3: ("BSD-3-Clause", "inherited"), 4: ("BSD-2-Clause", "inherited"),
                                5: ("MIT", "file"), 6: ("MIT", "inherited"), 7: (None, None), 8: (None, None), 9: ("ISC", "file"), 10: ("0BSD", "file")}


def brute(rows, threshold=0.7):
    """Every page by itself, with all frequencies and all windows."""
    texts = {k: [L.words(p) for p in L.passages(t, False)] for k, (_, _, t) in enumerate(rows)}
    every = [set(p) for t in texts.values() for p in t]
    scorer = L.Scorer(Counter(w for e in every for w in e), len(every))
    own, files = {}, {}
    for k, (_, path, _) in enumerate(rows):
        found = []
        for p in texts[k]:
            found.append(scorer.best(Counter(p)))
            for t, unit in zip(L.ALL, scorer.vectors):
                reach = math.sqrt(sum(y * y for w, y in unit.items() if w in p))
                if len(t.words) < len(p) and t.required <= set(p) and reach >= threshold - 1e-12:
                    for at, w in enumerate(p):
                        if w in unit:
                            near = scorer.best(Counter(p[at:at + len(t.words)]), Counter(p[max(0, at - L.AROUND):at + len(t.words) + L.AROUND]), L.numbers(p[at:at + len(t.words) + 1]))
                            found += [near] if near[0] >= threshold else []
        score, licence = max(found, key=lambda f: f[0], default=(0.0, None))
        whole = [w for p in texts[k] for w in p]
        all_score, all_licence = scorer.best(Counter(whole)) if len(whole) >= L.FILE_WORDS else (0.0, None)
        by_whole = all_score >= threshold
        if by_whole:
            score, licence = all_score, all_licence
        own[k] = (score, licence if score >= threshold else None)
        named = path is not None and re.search(L._FILE, path)
        if path and "/" in path and score >= threshold and (by_whole or named):
            files.setdefault(path.rsplit("/", 1)[0], []).append((-round(score, 9), licence))
    out = []
    for k, (page, path, _) in enumerate(rows):
        score, licence = own[k]
        is_file = licence is not None and ((path is not None and re.search(L._FILE, path)) or (
            len([w for p in texts[k] for w in p]) >= L.FILE_WORDS and scorer.best(Counter(w for p in texts[k] for w in p))[0] >= threshold))
        origin = "file" if is_file else "header" if licence else None
        where = path.rsplit("/", 1)[0] if path and "/" in path else None
        while licence is None and where is not None:
            if where in files:
                score, licence = min(files[where])
                score, origin = -score, "inherited"
            where = where.rsplit("/", 1)[0] if "/" in where else None
        out.append((page, licence, round(score, 9), origin))
    return sorted(out, key=repr)


def test_whole_query_against_brute_force(spark):
    rng = random.Random(6)
    plain = "see all plain terms of zebra prose under license version 2 work by not the".split()
    notices = [n for v in L.TEMPLATES.values() for n in v]
    for trial in range(2):
        rows = []
        for i in range(120):
            lines = []
            for _ in range(rng.randint(0, 5)):
                w = rng.choices(plain, k=rng.randint(1, 9))
                if rng.random() < 0.4:
                    notice = rng.choice(notices).split()
                    if rng.random() < 0.3:
                        notice[rng.randrange(len(notice))] = rng.choice(plain)
                    w = w[:rng.randint(0, 3)] + notice + w[:rng.randint(0, 2)]
                lines.append(" ".join(w))
            folder = "/".join(rng.choice("ab") for _ in range(rng.randint(0, 3)))
            path = rng.choice([None, "lone", *[f"h/{folder}/{name}".replace("//", "/") for name in ("x.py", "y.md", "LICENSE", "COPYING.txt")]])
            rows.append((rng.choice([i, 7, None]), path, rng.choice([None, "", *["\n".join(lines)] * 8])))
        frame = spark.createDataFrame([(*r, "clash", 1.0) for r in rows], "page_id long, path string, html string, licence string, score double").repartition(5)
        for common in (3, 1000):
            got = L.scan_licences(frame, F.col("path"), html=False, common=common).collect()
            assert sorted(((r["page_id"], r["licence"], round(r["score"], 9), r["origin"]) for r in got), key=repr) == brute(rows)


def test_frequencies_and_planted_notices(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    texts = [r["html"] for r in pages.collect()]
    frequency, total = L.document_frequencies(pages, "html", True)
    every = [set(L.words(p)) for t in texts for p in L.passages(t, True)]
    assert total == len(every) and all(n == sum(w in e for e in every) for w, n in frequency.items())
    got = {r["page_id"]: r["licence"] for r in L.scan_licences(pages, L.url_path(F.col("url"))).collect()}
    assert len(got) == len(texts)
    for r in pages.collect():
        for name, notices in L.TEMPLATES.items():
            if f">{notices[0]}<" in r["html"]:
                assert got[r["page_id"]] == name


def test_paths(spark):
    rows = spark.createDataFrame([("https://a.b/c/d.html?x=/y#z",), ("http://a.b/c/",), ("a.b",), (None,)], "u string")
    assert [r[0] for r in rows.select(L.url_path(F.col("u"))).collect()] == ["a.b/c/d.html", "a.b/c", "a.b", None]


LONGER = ["Copyright Foo. Released under the MIT License.", "Copyright Foo Inc. Licensed under the Apache License, Version 2.0.",
          "Released under the MIT License by Foo.", "see all the plain terms of the zebra license here"]


def test_one_page_at_several_table_sizes(spark):
    for size in (10, 1000, 20000):
        rows = spark.range(size).select((F.col("id") + 10).alias("page_id"), F.lit(None).cast("string").alias("path"),
                                        F.concat(F.lit("see all copyright prose "), F.col("id") % 997).alias("html"))
        pages = spark.createDataFrame([(i, None, t) for i, t in enumerate(LONGER)], rows.schema)
        got = {r["page_id"]: r for r in L.scan_licences(rows.union(pages), F.col("path"), html=False).filter("page_id < 10").collect()}
        assert [got[i]["licence"] for i in range(4)] == ["MIT", "Apache-2.0", "MIT", None]
        assert all(abs(got[i]["score"] - 1) < 1e-9 for i in range(3))


def test_foreign_words_have_their_true_weight(spark):
    texts = LONGER + ["copyright all see", "see the zebra prose under all terms"] * 20 + ["all see work"]
    rows = spark.createDataFrame(list(enumerate(texts)), "page_id long, html string")
    every = [set(L.words(t)) for t in texts]
    scorer = L.Scorer({w: sum(w in e for e in every) for e in every for w in e}, len(texts))
    for common in (1, 7, 1000):
        for r in L.scan_licences(rows, F.lit(None).cast("string"), html=False, common=common).collect():
            bag = L.words(texts[r["page_id"]])
            want = scorer.best(Counter(bag))[0]
            parts = [scorer.best(Counter(bag[i:i + n]), Counter(bag[max(0, i - L.AROUND):i + n + L.AROUND]), L.numbers(bag[i:i + n + 1]))[0]
                     for n in {len(t.words) for t in L.ALL} for i in range(len(bag) - n + 1)]
            assert abs(r["score"] - max([want, *(x for x in parts if x >= 0.7)])) < 1e-9
