"""Operator 8: licence scans with a positional index of rare words (native).

Licence templates (``license_templates``) are word sequences. Their words'
document frequencies are counted over the whole table. Of each template the
word of its first mandatory phrase with the highest IDF is its posting: (word,
template, place in the template). In each file the posted words are looked up;
their places less the place in the template are where the template would have
to begin. There its mandatory phrases must stand word by word, and the other
words are compared at all relative positions, weighted by IDF. As a mandatory
phrase must be there, its rarest word finds all places.

The table of templates is one literal array, so the plan does not grow with it.
Only DataFrame functions: two passes of one map each, an aggregate of as many
rows as there are licence words, no shuffle of documents.

A word is a run of ASCII letters and digits and of any other non-ASCII
characters, A-Z in lower case. Null and empty texts have no words and no
labels, score 0. Rows are handled one by one; repeated rows and null ids need
no rule. Extra columns are not read.
"""

from __future__ import annotations

import json
import math
import string
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.license_templates import TEMPLATES, Template

#: What separates words, where A-Z are still there.
GAP = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_TABLE = ("array<struct<label string, base boolean, word string, at int, least double, total double, "
          "must array<struct<j int, w string>>, body array<struct<j int, w string, weight double>>>>")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def lowered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _held(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once a row, however often lambdas read
    them (a projection would be pasted into each use)."""
    row = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_held")
    return df.select("*", row).select(*df.columns, "_held.*")


def idf(df: DataFrame, text: str, templates: tuple[Template, ...]) -> dict[str, float]:
    """Inverse document frequency of every licence word over all of ``df``."""
    vocab = sorted({w for t in templates for w in t.words})
    found = F.array_intersect(words_of(F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))), F.array(*map(F.lit, vocab)))
    # a row for each licence word, and one (null) for the number of documents
    counts = dict(df.select(F.explode(F.array_append(found, F.lit(None))).alias("w")).groupBy("w").count().collect())
    n = counts.get(None, 0)
    return {w: math.log((n + 1) / (counts.get(w, 0) + 1)) + 1e-6 for w in vocab}


def _begin(t: Template, phrase: list[str]) -> int:
    return next(i for i in range(len(t.words)) if t.words[i:i + len(phrase)] == tuple(phrase))


def _posting(t: Template, weight: dict[str, float]) -> dict:
    """The template as a row of the table; one that must match as a whole has
    no body."""
    phrases = [list(t.words)] if t.share == 1.0 else [k.split() for k in t.keys]
    word = max(phrases[0], key=lambda w: (weight[w], w))
    must = {_begin(t, k) + j: w for k in phrases for j, w in enumerate(k)}
    body = [] if t.share == 1.0 else [{"j": j, "w": w, "weight": weight[w]} for j, w in enumerate(t.words)]
    return {"label": t.label, "base": t.base, "word": word, "at": _begin(t, phrases[0]) + phrases[0].index(word), "least": t.share,
            "total": sum(weight[w] for w in t.words), "must": [{"j": j, "w": w} for j, w in sorted(must.items())], "body": body}


def _places(t: Column) -> Column:
    """Where template ``t`` stands in ``words``; ``spots`` holds the places of
    all posted words."""
    def in_place(start: Column, part: Column) -> Column:
        return F.coalesce(F.get("words", start + part["j"]) == part["w"], F.lit(False))

    def share(s: Column) -> Column:
        met = F.aggregate(t["body"], F.lit(0.0), lambda sum_, part: sum_ + F.when(in_place(s, part), part["weight"]).otherwise(0.0))
        return F.when(F.size(t["body"]) == 0, F.lit(1.0)).otherwise(met / t["total"])

    starts = F.transform(F.filter("spots", lambda i: F.get("words", i) == t["word"]), lambda i: i - t["at"])
    good = F.filter(starts, lambda s: F.forall(t["must"], lambda part: in_place(s, part)))
    return F.filter(F.transform(good, lambda s: F.struct(t["label"].alias("label"), s.alias("start"), share(s).alias("share"),
                                                         t["base"].alias("base"))), lambda p: p["share"] >= t["least"])


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
         templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, places`` of every row. ``places``: (label, start, share) of every
    template found; ``score``: the best share."""
    weight = idf(df, text, templates)
    postings = [_posting(t, weight) for t in templates]
    # any place of a template holds its posted word
    needed = sorted({p["word"] for p in postings})
    known = F.from_json(F.lit(json.dumps(postings)), _TABLE)
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = _held(df.select(F.col(doc_id).alias("id"), t.alias("t")), rough=words_of(F.lower("t")))
    likely = F.arrays_overlap("rough", F.array(*map(F.lit, needed)))
    rows = _held(rows, n_words=F.size("rough").cast("long"),
                 words=F.when(likely, words_of(lowered(F.col("t")))).otherwise(F.array().cast("array<string>"))).drop("t", "rough")
    at = F.when(F.size("words") > 0, F.sequence(F.lit(0), F.size("words") - 1)).otherwise(F.array().cast("array<int>"))
    rows = _held(rows, spots=F.filter(at, lambda i: F.get("words", i).isin(needed)))
    none = F.array().cast("array<struct<label string, start int, share double, base boolean>>")
    rows = _held(rows, places=F.when(F.size("spots") > 0, F.flatten(F.transform(known, _places))).otherwise(none)).drop("words", "spots")
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"])
    labels = lambda places: F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))))
    return rows.select(
        F.col("id").alias(doc_id), "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0)).alias("score"), "places")
