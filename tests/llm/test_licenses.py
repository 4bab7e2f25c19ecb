import random
import re

from .conftest import SF_SMALL

from ebbflow.llm import licenses as L
from ebbflow.llm.common import configure, table


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows):
    """Every template tried at every place."""
    import math
    docs = [words(t) for _, t in rows]
    vocab = {w for t in L.TEMPLATES for w in t.words}
    n = len(docs)
    weight = {w: math.log((n + 1) / (sum(w in set(d) for d in docs) + 1)) + 1e-6 for w in vocab}
    out = []
    for (i, _), d in zip(rows, docs):
        base, labels, best = [], set(), 0.0
        for t in L.TEMPLATES:
            for s in range(-len(t.words), len(d)):
                hit = [0 <= s + j < len(d) and d[s + j] == w for j, w in enumerate(t.words)]
                need = [t.words] if t.share == 1.0 else [tuple(k.split()) for k in t.keys]
                at = [next(a for a in range(len(t.words)) if t.words[a:a + len(k)] == k) for k in need]
                if not all(all(hit[a:a + len(k)]) for a, k in zip(at, need)):
                    continue
                share = 1.0 if t.share == 1.0 else sum(weight[w] for w, h in zip(t.words, hit) if h) / sum(weight[w] for w in t.words)
                if share >= t.share - 1e-9:
                    best = max(best, share)
                    labels.add(t.label)
                    if t.base:
                        base.append((s, t.label))
        out.append((i, len(d), len(base), min(base)[0] if base else None, max(base)[0] if base else None,
                    ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), round(best, 6)))
    return sorted(out, key=str)


def check(df):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    got = [(*tuple(r)[:7], round(r["score"], 6)) for r in L.scan(df).drop("places").collect()]
    assert sorted(got, key=str) == brute(rows)


def test_awkward_rows(spark, awkward, nothing):
    configure(spark)
    check(awkward)
    assert L.scan(nothing).count() == 0


def test_phrases_in_all_places(spark):
    configure(spark)
    rng = random.Random(8)
    parts = ["MIT", "license", "Apache", "General", "Public", "rights", "reserved", "all", "x", "Ünder", "under", "the", "K"]
    texts = [rng.choice([" ", "-", "\n(", "é "]).join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(300)]
    texts += ["Released under the MIT License.", "MIT License " * 50, "x" * 5000 + " the MIT license",
              "Permission is hereby granted, free of charges, to any one person", "licensed under CC BY-NC 4.0", "cc by nc",
              "This work is licensed under the GNU General Public License, version 3.", "mİt license", "mit licensé"]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_documents(spark):
    configure(spark)
    check(table(spark, SF_SMALL, "documents"))
    check(table(spark, "/root/testdata/sf0.01", "documents"))


def test_plan_is_native(spark):
    configure(spark)
    plan = L.scan(table(spark, SF_SMALL, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


NOTICES = [
    ("""# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.""", {"gpl-3-header", "gpl-header", "gpl"}, {"gpl-2-header", "lgpl-header"}),
    (""" * You should have received a copy of the GNU Affero General Public License
 * along with this program.  If not, see <https://www.gnu.org/licenses/>.""", {"agpl-copy", "gpl"}, {"gpl-copy"}),
    ("""This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.""",
     {"lgpl-2.1-header", "lgpl-header"}, {"gpl-header", "lgpl-3-header"}),
    ("""This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.""", {"mpl-2-header"}, {"mpl-1.1-header"}),
    ("""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.""", {"isc"}, {"0bsd", "mit-condition"}),
    ("""2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
3. Neither the name of the University nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.""", {"bsd-binary-clause", "bsd-3-clause"}, {"bsd-source-clause", "bsd-4-clause"}),
    ("""each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable
copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the
Work and such Derivative Works in Source or Object form.""", {"apache-2-grant"}, {"mpl-2-grant"}),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which "
     "accompanies this distribution, and is available at", {"epl-1-header"}, {"epl-2-header"}),
    ("This is free and unencumbered software released into the public domain.", {"unlicense"}, {"mit"}),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
     {"cc-by-nc-sa"}, {"cc-by-nc", "cc-by"}),
    ("https://creativecommons.org/licenses/by/4.0/", {"cc-by"}, {"cc-by-sa"}),
    ("// SPDX-License-Identifier: BSD-3-Clause", {"spdx-bsd-3-clause"}, {"spdx-bsd-2-clause"}),
]


def test_standard_notices(spark):
    """Headers and grants that do not stand in the given tables."""
    configure(spark)
    rows = [(i, t) for i, (t, _, _) in enumerate(NOTICES)] + [(99, "no notice at all"), (98, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: set(filter(None, r["labels"].split(","))) for r in L.scan(df).collect()}
    for i, (text, wanted, unwanted) in enumerate(NOTICES):
        assert wanted <= got[i] and not unwanted & got[i], (text, got[i])
    assert got[99] == got[98] == set()
    check(df)
