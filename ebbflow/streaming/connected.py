"""Connected streams: a keyed function with two inputs (F4, J1) and a keyed
function with broadcast state (F5, J3, G8).

Spark's keyed operators have one input, so the inputs of a connected stream
become one: a tagged union, of which a key sees its rows of both sides. Within a
micro-batch the first input's rows are met before the second's, and a side's
rows in order of their sequence number; between micro-batches arrival decides.
Keys are dealt to parts, whose state is held in blocks (:mod:`.blocks`).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ebbflow.streaming import blocks as B

# ---------------------------------------------------------- two inputs -----

PAIR = "emitted_by string, arriving long, stored long"


class PairProcessor(StatefulProcessor):
    """One of the parts that keys are dealt to. Each row meets all rows of its
    key (and salt) on the other side that arrived before it, and is kept for
    those that come after: two list states, which are appended to, and read a
    block at a time if the other side has rows in the batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first, self.second = (handle.getListState(n, B.SCHEMA) for n in ("first", "second"))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        sides: tuple[dict, dict] = ({}, {})  # of each key and salt, sequence numbers and refs
        for r in rows:
            sides[r.side].setdefault((r.key, r.salt), []).append((r.seq, r.ref))
        for side, kept, other, by in ((sides[0], self.first, self.second, "stream-1"), (sides[1], self.second, self.first, "stream-2")):
            if side:
                arriving = {k: [ref for _, ref in sorted(refs)] for k, refs in side.items()}
                for k, salt, held in B.stored(other):
                    for ref in arriving.get((k, salt), ()):
                        yield Row(key=k, emitted_by=by, arriving=ref, stored=held)
                B.append(kept, ((k, salt, ref) for (k, salt), refs in arriving.items() for ref in refs))

    def close(self) -> None:
        pass


def hot_keys(df: DataFrame, key: str, least: int = 100_000, share: int = 1000) -> list:
    """Keys with more than ``least`` rows and more than one in ``share`` of all
    rows, so fewer than ``share`` keys."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = df.count()
    return [r[0] for r in counts.filter((F.col("n") > least) & (F.col("n") * share > total)).select(key).collect()]


def connect(first: DataFrame, second: DataFrame, key_type: str = "long", hot: list | None = None, salts: int = 16,
            parts: int | None = None) -> DataFrame:
    """All pairs of the rows ``key, seq, ref`` of two streams with equal keys,
    each emitted once, by the one that arrives later: ``key, emitted_by,
    arriving, stored``. Null keys meet nothing. Rows of ``hot`` keys are dealt to
    ``salts`` keys on the second side, and copied to each on the first. Keys and
    salts are dealt to ``parts`` (None: those of a small input)."""
    hot = [k for k in hot or [] if k is not None]
    busy = F.col("key").isin(hot) if hot else F.lit(False)
    one = first.withColumns({"side": F.lit(0), "salt": F.explode(
        F.when(busy, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))})
    two = second.withColumns({"side": F.lit(1), "salt": F.when(busy, F.pmod(F.xxhash64("seq", "ref"), F.lit(salts)).cast("int")).otherwise(F.lit(0))})
    rows = one.unionByName(two).filter(F.col("key").isNotNull())
    dealt = rows.withColumn("part", B.part_of(parts or B.part_count(first.sparkSession), "key", "salt"))
    return dealt.groupBy("part").transformWithState(PairProcessor(), f"key {key_type}, {PAIR}", "Append", "None")


# ------------------------------------------------------ broadcast state ----

class RuleProcessor(StatefulProcessor):
    """One of the parts that keys are dealt to. Rule rows, of which every part
    gets a copy, set its rule (broadcast state: the latest rule, written on this
    side only); action rows read it. Below it a list state holds the previous
    action of each of the part's keys, read and written once a batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rule = handle.getValueState("rule", "no long, before string, now string")
        self.previous = handle.getListState("previous", B.SCHEMA)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        rules, actions = [], {}
        for r in rows:
            if r.action_no is None:
                rules.append((r.rule_no, r.before, r.now))
            else:
                actions.setdefault(r.id, []).append((r.action_no, r.now))
        rule = tuple(self.rule.get()) if self.rule.exists() else None
        for new in sorted(rules, key=lambda r: r[0]):
            if rule is None or new[0] >= rule[0]:
                rule = new
        if rules:
            self.rule.update(rule)
        if not actions:
            return
        previous = dict(B.stored(self.previous))
        for who, done in actions.items():
            done.sort(key=lambda a: a[0])
            last = previous.get(who)
            for no, action in done:
                if rule is not None and last is not None and (last, action) == rule[1:]:
                    yield Row(id=who, action_no=no, before=last, now=action)
                last = action
            previous[who] = last
        B.replace(self.previous, previous.items())

    def close(self) -> None:
        pass


def with_rules(actions: DataFrame, rules: DataFrame, parts: int) -> DataFrame:
    """``id, action_no, before, now`` of the actions (``id, action_no, now``) that
    follow, for the same id, the action that the rule in force (``rule_no,
    before, now``) asks for. The latest rule is in force; a null id is an id."""
    every = rules.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.col("rule_no").cast("long"), "before", "now")
    dealt = actions.select(F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), F.col("id").cast("long"),
                           F.col("action_no").cast("long"), "now")
    return (dealt.unionByName(every, allowMissingColumns=True).groupBy("part")
            .transformWithState(RuleProcessor(), "id long, action_no long, before string, now string", "Append", "None"))
