"""Operator 6: line dedup by an exact set-similarity join (native).

The lines of all documents stand in one order: by id, then row, then line. A
line is removed if an earlier line (removed or not) has a word set of Jaccard
similarity ``num / den`` or more; lines without words stay. Equal lines
are one class, with its first place; all its later places go. So only the
first places of classes are left to decide, by a join of classes:

Words are ordered by rarity (counts over all documents, in a table of fixed
size), the rarest first.

1. Pivots. Classes that share the least or greatest word hash of their rarer
   half are compared with the ``PIVOTS`` earliest of them. In a group of near
   copies nearly every member is settled by these comparisons, so such groups
   never meet all pairs. Large groups are dealt to ``SALTS`` parts with pivots
   of their own.
2. Prefix join, for classes that are not settled. Two similar classes share a
   word among the rarest ``n - ceil(t n) + 1`` of the one with more words and the
   rarest ``n - ceil(2 t / (1 + t) n) + 1`` of the other. Pairs that share one are
   kept if lengths and the positions of the word allow the similarity, unless the
   later class is settled. Both sides read one shuffle, whose columns are never
   null to Spark's eye: a test for null on one side would end that.
   Candidates of either step must also pass a 128-bit signature (the parity of
   the words on each bit): it differs in no more bits than the sets in words.
3. Candidates are verified on the whole word sets (64-bit hashes of the words).

Of a class only its place (id, row digest, line number), its signature, pivot
keys and prefix are kept. Word sets are fetched from the documents again, for
the lines that candidate pairs name. There a signature of 256 bits drops most
pairs below the similarity; each class is compared with its closest candidate
first, and with the others only if that fails. Tables of up to
``FEW`` rows of a few numbers are broadcast, larger ones joined.

Words are runs of anything but blank and tab to carriage return; lines end at
line feeds. Null texts have no line and stay null; the empty text has one line
without words. Null ids come last. Of rows that are equal in all columns, the
first has the kept lines. An empty table gives an empty result.
"""

from __future__ import annotations

import contextlib
import gc
import math
from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbflow.llm.common import row_key
from ebbflow.session import checkpointed, work_dir

#: Word counts are kept for so many hash buckets.
BUCKETS = 1 << 16
#: Parts of a group of classes with the same pivot key.
SALTS = 16
#: Pivots that a class is compared with for each of its keys.
PIVOTS = 8
#: Rows of at most four numbers (or a document's line numbers) that are broadcast.
FEW = 1_000_000
#: Drops so many upper bits of hashes, which gives another order of them.
OTHER_ORDER = 28
#: Pairs of classes and what is looked up for them are dealt to fewer partitions
#: than texts and words, by this factor: there are far fewer of them.
PAIR_SHARE = 4
_LAST = (1 << 63) - 1


PLACE = ("d", "rk", "no")


def _words(text: Column, line_feeds: bool = False) -> Column:
    """Words between blanks (a plain split, which is faster than a pattern);
    some may be empty. To look for the other blanks is faster than to replace
    them, so only texts that hold some are rewritten."""
    plain = F.replace(text, F.lit("\n"), F.lit(" ")) if line_feeds else text
    blanks = [F.lit(c) for c in "\t\x0b\f\r"]
    spaced = plain
    for c in blanks:
        spaced = F.replace(spaced, c, F.lit(" "))
    held = F.contains(text, blanks[0])
    for c in blanks[1:]:
        held = held | F.contains(text, c)
    return F.split(F.when(held, spaced).otherwise(plain), " ")


def word_hashes(line: Column) -> Column:
    """The set of a line's words, as 64-bit hashes."""
    return F.array_remove(F.array_distinct(F.transform(_words(line), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def _few(df: DataFrame) -> DataFrame:
    """A checkpointed table, broadcast if it is small."""
    df = checkpointed(df)
    return F.broadcast(df) if df.count() <= FEW else df


def _lines(rows: DataFrame) -> DataFrame:
    """``d, rk, no, line`` of every line with words of ``rows`` (d, rk, t)."""
    return rows.select("d", "rk", F.posexplode(F.split("t", "\n")).alias("no", "line")).filter(_with_words(F.col("line")))


def _with_words(line: Column) -> Column:
    return F.rlike(line, F.lit("[^\\x20\\x09-\\x0D]"))


@contextlib.contextmanager
def _kept_partitioning(spark: SparkSession) -> Iterator[None]:
    """Tables persisted inside keep their number of partitions, so that later
    joins on the same keys find them in place."""
    name = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@contextlib.contextmanager
def _fewer_partitions(spark: SparkSession) -> Iterator[None]:
    """Shuffles that run inside have ``PAIR_SHARE`` times fewer partitions."""
    name = "spark.sql.shuffle.partitions"
    before = int(spark.conf.get(name))
    spark.conf.set(name, str(-(-before // PAIR_SHARE)))
    try:
        yield
    finally:
        spark.conf.set(name, str(before))


def rarity(rows: DataFrame) -> Column:
    """An array: thousandths of the binary logarithm of how often words of each
    hash bucket occur in all texts (below 2^15), as the upper 16 bits of longs."""
    words = rows.select(F.explode(_words(F.col("t"), line_feeds=True)).alias("w")).filter("w <> ''")
    counts = words.groupBy(F.xxhash64("w").bitwiseAND(F.lit(BUCKETS - 1)).alias("b")).count()
    table = [0] * BUCKETS
    for r in counts.collect():  # BUCKETS rows at most
        table[r["b"]] = min(int(1000 * math.log2(r["count"])), (1 << 15) - 1) << 48
    # folds to one literal when the plan is made (a subquery cannot stand in a lambda)
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")


def by_rarity(line: Column, steps: Column) -> Column:
    """The set of a line's words as numbers that sort by rarity, then by 48 bits
    of their hash (never null to Spark's eye, so sorted as plain longs)."""
    def number(h: Column) -> Column:
        rank = F.coalesce(F.get(steps, h.bitwiseAND(F.lit(BUCKETS - 1))), F.lit(0).cast("long"))
        return rank.bitwiseOR(F.shiftrightunsigned(h, 16))
    return F.sort_array(F.transform(word_hashes(line), number))


#: The two longs of a signature.
SIGS = ("s0", "s1")


def signature(words: Column, k: int) -> Column:
    """Parity of the number of words on each of 64 bits, of the words whose
    seventh bit is ``k``."""
    mine = F.filter(words, lambda w: F.shiftright(w, 6).bitwiseAND(F.lit(1)) == k)
    return F.aggregate(mine, F.lit(0).cast("long"), lambda a, w: a.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), w.bitwiseAND(F.lit(63)).cast("int"))))


def _close(x: str, y: str, num: int, den: int) -> Column:
    """Whether lengths and signatures of two sets (columns with these prefixes)
    allow the similarity."""
    n, m = x + "n", y + "n"
    differ = sum((F.bit_count(F.col(x + s).bitwiseXOR(F.col(y + s))) for s in SIGS[1:]), F.bit_count(F.col(x + SIGS[0]).bitwiseXOR(F.col(y + SIGS[0]))))
    return ((num + den) * differ <= (den - num) * (F.col(n) + F.col(m))) & (den * F.least(n, m) >= num * F.greatest(n, m))


def _named(df: DataFrame, prefix: str, columns=PLACE) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in columns})


#: Longs of the wide signature.
WIDE = 4


def _wide(words: Column, k: int) -> Column:
    """The k-th long of a signature of 64 * ``WIDE`` bits."""
    return F.aggregate(words, F.lit(0).cast("long"), lambda a, w: F.when(
        F.pmod(F.shiftright(w, 6), F.lit(WIDE)) == k,
        a.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), w.bitwiseAND(F.lit(63)).cast("int")))).otherwise(a))


def _sets(places: DataFrame, rows: DataFrame) -> DataFrame:
    """``d, rk, no, n, w0.., words`` of the lines at ``places`` (n words, a wide
    signature), dealt by place and persisted."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = _few(places.distinct().groupBy("d", "rk").agg(F.collect_list("no").alias("nos")))
    found = rows.join(wanted, ["d", "rk"]).select("d", "rk", "t", F.explode("nos").alias("no"))
    found = found.select("d", "rk", "no", F.get(F.split("t", "\n"), F.col("no")).alias("line")).distinct()
    with _kept_partitioning(rows.sparkSession):
        words = found.repartition(parts, *PLACE).select(*PLACE, word_hashes(F.col("line")).alias("words"))
        return (words.select(*PLACE, F.size("words").alias("n"), *[_wide(F.col("words"), k).alias(f"w{k}") for k in range(WIDE)], "words")
                .persist(StorageLevel.MEMORY_AND_DISK))


def _closer(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """``pairs`` whose lengths and wide signatures allow the similarity, with
    the bits in which these differ."""
    held = ("n", *[f"w{k}" for k in range(WIDE)])
    slim = sets.select(*PLACE, *held)
    both = pairs.join(_named(slim, "x", (*PLACE, *held)), ["xd", "xrk", "xno"]).join(_named(slim, "y", (*PLACE, *held)), ["yd", "yrk", "yno"])
    apart = sum((F.bit_count(F.col(f"xw{k}").bitwiseXOR(F.col(f"yw{k}"))) for k in range(1, WIDE)), F.bit_count(F.col("xw0").bitwiseXOR(F.col("yw0"))))
    return both.withColumn("apart", apart).filter((num + den) * F.col("apart") <= (den - num) * (F.col("xn") + F.col("yn"))).select(
        "xd", "xrk", "xno", "yd", "yrk", "yno", "apart")


def _similar(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The x places (d, rk, no) of those ``pairs`` whose lines are similar."""
    x, y = (_named(sets.select(*PLACE, "words"), p, (*PLACE, "words")) for p in "xy")
    both = pairs.join(x, ["xd", "xrk", "xno"]).join(y, ["yd", "yrk", "yno"])
    common = F.size(F.array_intersect("xwords", "ywords"))
    return both.filter(den * common >= num * (F.size("xwords") + F.size("ywords") - common)).select(
        *[F.col("x" + c).alias(c) for c in PLACE]).distinct()


def _verified(pairs: DataFrame, classes: DataFrame, rows: DataFrame, num: int, den: int) -> DataFrame:
    """Of ``pairs`` (numbers x and y of classes, in either order) the places of
    classes that have a similar one before them in their pair, checkpointed."""
    spark = rows.sparkSession
    parts = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // PAIR_SHARE)
    pairs = checkpointed(pairs.coalesce(parts))
    _tidy(spark)
    with _fewer_partitions(spark):
        return _verified_pairs(pairs, classes, rows, num, den)


def _verified_pairs(pairs: DataFrame, classes: DataFrame, rows: DataFrame, num: int, den: int) -> DataFrame:
    ycols = ["yd", "yrk", "yno"]
    ids = _few(pairs.select(F.explode(F.array("x", "y")).alias("cid")).distinct())
    held = (*PLACE, "n", *SIGS)
    places = checkpointed(classes.join(ids, "cid").select("cid", *held))
    at = lambda p: _named(places, p, held).withColumnRenamed("cid", p)
    both = pairs.join(at("x"), "x").join(at("y"), "y").filter(_close("x", "y", num, den))
    one, other = (F.struct(*[F.col(p + c).alias(c) for c in PLACE]) for p in "xy")
    both = both.select(F.greatest(one, other).alias("x"), F.least(one, other).alias("y"))
    pairs = checkpointed(both.select(*[F.col(f"{p}.{c}").alias(p + c) for p in "xy" for c in PLACE]).distinct())
    sets = _sets(pairs.select(F.explode(F.array(*[F.struct(*[F.col(p + c).alias(c) for c in PLACE]) for p in "xy"])).alias("p")).select("p.*"), rows)
    pairs = checkpointed(_closer(pairs, sets, num, den))
    best = pairs.groupBy("xd", "xrk", "xno").agg(F.min(F.struct("apart", *ycols)).alias("b")).select(
        "xd", "xrk", "xno", *[F.col("b." + c).alias(c) for c in ycols])
    first = checkpointed(_similar(best, sets, num, den))
    rest = pairs.join(_named(first, "x"), ["xd", "xrk", "xno"], "left_anti").join(best, ["xd", "xrk", "xno", *ycols], "left_anti")
    out = checkpointed(first.unionByName(_similar(rest, sets, num, den)))
    sets.unpersist()
    return out


def _classes(rows: DataFrame, num: int, den: int) -> DataFrame:
    """``cid, d, rk, no, n, s0, s1, keys, prefix`` of each class of equal lines, at
    its first place. To be written before use: that fixes the numbers ``cid``."""
    steps = rarity(rows)
    lines = _lines(rows).withColumns({"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(1), "line"),
                                      "words": by_rarity(F.col("line"), steps)}).drop("line")
    size = F.size("words")
    half = F.slice("words", F.lit(1), F.floor((size + 1) / F.lit(2)).cast("int"))
    length = size - F.floor((num * size + den - 1) / F.lit(den)).cast("int") + 1
    low32 = F.lit((1 << 32) - 1)
    lines = lines.select(
        *PLACE, "h1", "h2", size.alias("n"), *[signature(F.col("words"), k).alias(s) for k, s in enumerate(SIGS)],
        F.transform(half, lambda w: F.shiftleft(w, 16)).alias("plain"),
        F.transform(half, lambda w: F.shiftleft(w, OTHER_ORDER)).alias("other"),
        # 32 bits name a word here: equal names only add candidates
        F.transform(F.slice("words", F.lit(1), length), lambda w: (w.bitwiseAND(low32) - F.lit(1 << 31)).cast("int")).alias("prefix"))
    # 30 bits of a hash and two that tell the key's kind
    kind = lambda w, k: (F.shiftleft(F.shiftrightunsigned(w, 34), 2).bitwiseOR(F.lit(k)) - F.lit(1 << 31)).cast("int")
    keys = F.array(kind(F.array_min("plain"), 0), kind(F.array_max("plain"), 1), kind(F.array_min("other"), 2))
    held = ("n", *SIGS, "keys", "prefix")
    return (lines.select(*PLACE, "h1", "h2", "n", *SIGS, keys.alias("keys"), "prefix").groupBy("h1", "h2")
            .agg(F.min(F.struct(*PLACE)).alias("first"), *[F.first(c).alias(c) for c in held])
            .select(F.monotonically_increasing_id().alias("cid"), "first.*", *held))


def _pivot_pairs(classes: DataFrame, num: int, den: int) -> DataFrame:
    """Each class with the ``PIVOTS`` earliest of its part of each pivot key's group."""
    rows = classes.select(F.explode("keys").alias("key"), F.pmod(F.xxhash64("cid"), F.lit(SALTS)).cast("int").alias("salt"), "d", "cid", "n", *SIGS)
    w = Window.partitionBy("key", "salt").orderBy("d", "cid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pivots = F.array(*[F.nth_value(F.struct("cid", "n", *SIGS), k + 1).over(w) for k in range(PIVOTS)])
    held = ("cid", "n", *SIGS)
    pairs = rows.select(*held, pivots.alias("pivots")).select(*[F.col(c).alias("x" + c) for c in held], F.explode("pivots").alias("p")).select(
        F.col("xcid").alias("x"), *["x" + c for c in held[1:]], F.col("p.cid").alias("y"), *[F.col("p." + c).alias("y" + c) for c in held[1:]])
    return pairs.filter((F.col("x") != F.col("y")) & _close("x", "y", num, den)).select("x", "y").distinct()


def _prefix_pairs(classes: DataFrame, settled: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs x and y, of which x has as many words or more, that share a prefix
    word at fitting positions; not those whose later class is settled (classes of
    one document count as later both)."""
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    flagged = classes.join(_few(settled.withColumn("settled", F.lit(1))), list(PLACE), "left")
    postings = flagged.select("cid", "d", *SIGS, "n", F.coalesce("settled", F.lit(0)).alias("settled"), F.posexplode("prefix").alias("at", "word"))
    # length, place in the prefix and flag in one number; both sides need them, so both read one shuffle
    mark = F.shiftleft(F.col("n").cast("long"), 32) + 2 * F.col("at") + F.col("settled")
    # nothing is null, and so Spark must see it: a test for null would go below the shuffle on one side only
    known = lambda c: F.coalesce(c, F.lit(0))
    postings = postings.select(*[known(F.col(c)).alias(c) for c in ("word", "cid", "d", *SIGS)], known(mark).alias("mark")).repartition(parts, "word")
    length, at = F.shiftright("mark", 32), F.shiftright(F.col("mark").bitwiseAND(F.lit((1 << 32) - 1)), 1)
    held = {"cid": F.col("cid"), "d": F.col("d"), **{s: F.col(s) for s in SIGS}, "n": known(length), "at": known(at), "settled": known(F.col("mark") % 2)}
    side = lambda df, p: df.select("word", *[c.alias(p + k) for k, c in held.items()])
    x = side(postings, "x")
    # not deterministic in form, so that the filter stays above the shuffle
    y = side(postings.filter((F.monotonically_increasing_id() >= 0) == ((num + den) * (length - at) >= 2 * num * length)), "y")
    most = F.least(F.col("xn") - F.col("xat"), F.col("yn") - F.col("yat"))
    once = (F.col("xn") > F.col("yn")) | ((F.col("xn") == F.col("yn")) & (F.col("xcid") > F.col("ycid")))
    new = ((F.col("xd") >= F.col("yd")) & (F.col("xsettled") == 0)) | ((F.col("yd") >= F.col("xd")) & (F.col("ysettled") == 0))
    fits = once & new & _close("x", "y", num, den) & ((num + den) * most >= num * (F.col("xn") + F.col("yn")))
    pairs = x.join(y, (x["word"] == y["word"]) & fits)
    return pairs.select(F.col("xcid").alias("x"), F.col("ycid").alias("y")).distinct()


def _tidy(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps whose results are checkpointed
    (it does so once the driver's objects for them are collected)."""
    gc.collect()
    spark._jvm.System.gc()


def kept_lines(rows: DataFrame, num: int = 4, den: int = 5) -> DataFrame:
    """``d, rk, kept`` for rows (d, rk, t) that keep a line with words: the
    numbers of these lines, from 0."""
    # a written table: it cuts the lineage, and scans of it (unlike those of a
    # cached table) let the two sides of the prefix join share one shuffle
    path = work_dir(rows.sparkSession, "line-classes")
    _classes(rows, num, den).write.mode("overwrite").parquet(path)
    classes = rows.sparkSession.read.parquet(path)
    _tidy(rows.sparkSession)
    settled = _verified(_pivot_pairs(classes, num, den), classes, rows, num, den)
    _tidy(rows.sparkSession)
    late = _verified(_prefix_pairs(classes, settled, num, den), classes, rows, num, den)
    kept = classes.select(*PLACE).join(_few(settled.unionByName(late)), list(PLACE), "left_anti")
    out = checkpointed(kept.groupBy("d", "rk").agg(F.array_sort(F.collect_list("no")).alias("kept")))
    return out


def _numbered(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    return df.withColumns({"_d": F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)), "_rk": row_key(df),
                           "_t": F.col(text).cast("string")})


def report(df: DataFrame, doc_id: str = "doc_id", text: str = "text", num: int = 4, den: int = 5) -> DataFrame:
    """``doc_id, n_lines, n_removed, removed`` of every row; ``removed``: the
    numbers of removed lines, from 0."""
    rows = _numbered(df, doc_id, text)
    kept = kept_lines(rows.select(F.col("_d").alias("d"), F.col("_rk").alias("rk"), F.col("_t").alias("t")), num, den)
    lines = F.coalesce(F.split("_t", "\n"), F.array().cast("array<string>"))
    worded = F.filter(F.transform(lines, lambda line, i: F.when(_with_words(line), i)), lambda i: i.isNotNull())
    slim = rows.select(F.col(doc_id).alias("id"), "_d", "_rk", F.size(lines).cast("long").alias("n_lines"), worded.alias("worded"))
    # equal rows are one here, and as many again at the end: the first has the kept lines
    slim = slim.groupBy("id", "_d", "_rk", "n_lines", "worded").agg(F.count("*").alias("copies"))
    met = slim.join(kept, (F.col("_d") == F.col("d")) & (F.col("_rk") == F.col("rk")), "left")
    met = met.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    stays = F.when(F.col("copy") == 1, F.coalesce("kept", F.array().cast("array<int>"))).otherwise(F.array().cast("array<int>"))
    gone = F.array_except("worded", stays)
    return met.select(F.col("id").alias(doc_id), "n_lines", F.size(gone).cast("long").alias("n_removed"), gone.alias("removed"))


def remove(df: DataFrame, doc_id: str = "doc_id", text: str = "text", num: int = 4, den: int = 5) -> DataFrame:
    """``df`` with the removed lines cut out of ``text`` (other columns as they
    are; a row that loses all its lines keeps an empty text)."""
    rows = _numbered(df, doc_id, text)
    kept = kept_lines(rows.select(F.col("_d").alias("d"), F.col("_rk").alias("rk"), F.col("_t").alias("t")), num, den)
    none = F.array().cast("array<int>")

    def cut(stays: Column) -> Column:
        good = F.filter(F.split("_t", "\n"), lambda line, i: ~_with_words(line) | F.array_contains(stays, i))
        return F.array_join(good, "\n")

    def joined(part: DataFrame) -> DataFrame:
        met = part.join(kept, (F.col("_d") == F.col("d")) & (F.col("_rk") == F.col("rk")), "left")
        return met.withColumn(text, cut(F.coalesce("kept", none)))

    # of equal rows the first keeps lines: such rows are told apart before the join with the texts
    twice = _few(rows.groupBy("_d", "_rk").agg(F.count("*").alias("copies")).filter("copies > 1"))
    single = joined(rows.join(twice, ["_d", "_rk"], "left_anti")).select(*df.columns)
    again = rows.join(twice, ["_d", "_rk"]).dropDuplicates()
    copied = joined(again).withColumn("_cut", cut(none)).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    copied = copied.withColumn(text, F.when(F.col("copy") == 1, F.col(text)).otherwise(F.col("_cut"))).select(*df.columns)
    return single.unionByName(copied)
