"""Streaming twins of batch queries.

Each query feeds a driver table to a file stream in arrival ranges (one
running query, one micro-batch per range) and returns what the sink wrote. Where the streaming result must equal the batch result, the query
carries the batch query's DuckDB oracle, so the driver checks stream = batch.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbflow.functions.time import as_event_time
from ebbflow.operators.windows import window_col
from ebbflow.plans.catalog import REGISTRY, query
from ebbflow.session import work_dir
from ebbflow.sources import tables as S
from ebbflow.streaming import blocks as B
from ebbflow.streaming import operators as SO
from ebbflow.streaming import runner as RUN
from ebbflow.streaming import savepoint as SP
from ebbflow.streaming import sources as SS

SENTINEL_ID = -1


def _oracle(name: str) -> str:
    from ebbflow.plans import core_queries, event_queries  # noqa: F401
    return REGISTRY[name].oracle


def replayed_events(spark, sf_dir, name, cols=("event_id", "user_id", "event_type", "ts"),
                    sentinel=True, order="ts") -> SS.Replay:
    """Events fed in arrival ranges of ``order``, then a flush sentinel. In
    order of event time no range has rows behind the ones before it."""
    ev = S.events(spark, sf_dir).select(*cols)
    frames = SS.arrival_ranges(ev, order)
    if sentinel:
        row = {c: None for c in cols}
        row.update(event_id=SENTINEL_ID, user_id=SENTINEL_ID, event_type="flush",
                   ts=SS.SENTINEL_TS)
        frames.append(SS.sentinel_frame(spark, {c: row[c] for c in cols}, ev.schema))
    return SS.Replay(spark, name, ev.schema, frames)


def event_stream(rep: SS.Replay):
    return rep.stream().withColumn("ts", as_event_time("ts"))


def _ntz(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


@query("stream_tumbling_uv", covers=("W4", "A12", "S4", "T3", "T4"), oracle=_oracle("tumbling_uv"))
def stream_tumbling_uv(spark, sf_dir, bound="0 seconds"):
    rep = replayed_events(spark, sf_dir, "tumbling-uv")
    ev = event_stream(rep).withWatermark("ts", bound)
    out = RUN.replay_append([rep], SO.stream_window_uv(ev, "ts", "10 hours", "user_id"),
                            "tumbling_uv")
    return _ntz(out, "window_start", "window_end")


@query("stream_sliding_pv_per_uv", covers=("W2", "A11"), oracle=_oracle("sliding_pv_per_uv"))
def stream_sliding_pv_per_uv(spark, sf_dir, bound="0 seconds"):
    rep = replayed_events(spark, sf_dir, "sliding-pv-per-uv")
    ev = event_stream(rep).withWatermark("ts", bound)
    out = RUN.replay_append([rep], SO.stream_pv_per_uv(ev, "ts", "10 hours", "2 hours", "user_id"), "sliding_pv_per_uv")
    return _ntz(out, "window_start", "window_end")


@query("stream_sliding_topn", covers=("W6", "A14"), oracle=_oracle("sliding_topn"))
def stream_sliding_topn(spark, sf_dir, bound="0 seconds"):
    rep = replayed_events(spark, sf_dir, "sliding-topn")
    ev = event_stream(rep).withWatermark("ts", bound)
    top = SO.stream_sliding_top_n(ev, "ts", "10 hours", "5 hours", "event_type", 2)
    out = RUN.replay_append([rep], top, "sliding_topn")
    return _ntz(out, "window_start", "window_end")


def _stream_counts(spark, sf_dir, name, size, slide, bound):
    ev = event_stream(replay := replayed_events(spark, sf_dir, name)).withWatermark("ts", bound)
    w = window_col("ts", size, slide).alias("w")
    counts = ev.groupBy(w, "event_type").agg(F.count(F.lit(1)).alias("cnt")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "cnt")
    return _ntz(RUN.replay_append([replay], counts, name), "window_start", "window_end")


@query("stream_tumbling_count", covers=("W1", "A13"), oracle=_oracle("tumbling_count"))
def stream_tumbling_count(spark, sf_dir, bound="0 seconds"):
    return _stream_counts(spark, sf_dir, "tumbling-count", "1 hour", None, bound)


@query("stream_sliding_count", covers=("W5", "A13"), oracle=_oracle("sliding_count"))
def stream_sliding_count(spark, sf_dir, bound="0 seconds"):
    return _stream_counts(spark, sf_dir, "sliding-count", "10 hours", "5 hours", bound)


@query("stream_interval_join", covers=("J2",), oracle=_oracle("interval_join"))
def stream_interval_join(spark, sf_dir):
    """Views meet purchases of the same user within 6 hours either way. Both
    sides are dealt to 12-hour buckets besides the user, so a busy user's rows
    are spread; a view goes to the at most two buckets its interval touches."""
    rep = replayed_events(spark, sf_dir, "interval-join", sentinel=False)
    ev = event_stream(rep)
    us, width, reach = F.unix_micros("ts"), 12 * 3_600_000_000, 6 * 3_600_000_000
    bucket = lambda at: F.floor(at / F.lit(width)).cast("long")
    views = (ev.filter(F.col("event_type") == "view")
               .select(F.col("user_id").alias("v_user"), F.col("event_id").alias("view_id"),
                       F.col("ts").alias("view_ts"),
                       F.explode(F.sequence(bucket(us - reach), bucket(us + reach))).alias("v_bucket"))
               .withWatermark("view_ts", "6 hours"))
    buys = (ev.filter(F.col("event_type") == "purchase")
              .select(F.col("user_id").alias("p_user"), F.col("event_id").alias("purchase_id"),
                      F.col("ts").alias("purchase_ts"), bucket(us).alias("p_bucket"))
              .withWatermark("purchase_ts", "6 hours"))
    j = views.join(buys, F.expr("v_user = p_user AND v_bucket = p_bucket AND purchase_ts BETWEEN "
                                "view_ts - INTERVAL 6 HOURS AND view_ts + INTERVAL 6 HOURS"))
    out = RUN.replay_append([rep], j.select(F.col("v_user").alias("user_id"), "view_id",
                                            "view_ts", "purchase_id", "purchase_ts"),
                            "interval_join")
    return _ntz(out, "view_ts", "purchase_ts")


@query("stream_connect_join", covers=("J1", "G2"), oracle=_oracle("connect_join"))
def stream_connect_join(spark, sf_dir):
    # Full-history inner join: no watermark, so both sides stay in state
    # (the original keeps both list states forever as well).
    orders = S.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    items = S.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_linenumber")
    o_rep = SS.Replay(spark, "connect-orders", orders.schema,
                      SS.arrival_ranges(orders, "o_orderkey"))
    l_rep = SS.Replay(spark, "connect-items", items.schema,
                      SS.arrival_ranges(items, "l_orderkey"))
    o, li = o_rep.stream(), l_rep.stream()
    j = o.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "inner")
    later = F.col("l_shipdate") >= F.col("o_orderdate")
    out = j.select(F.col("o_orderkey").alias("key"),
                   F.when(later, "stream-2").otherwise("stream-1").alias("emitted_by"),
                   F.when(later, F.col("l_shipdate")).otherwise(F.col("o_orderdate")).alias("arriving_ts"),
                   F.when(later, F.col("o_orderdate")).otherwise(F.col("l_shipdate")).alias("stored_ts"),
                   "l_linenumber")
    return RUN.replay_append([o_rep, l_rep], out, "connect_join")


def _word_stream(rep: SS.Replay):
    from ebbflow.functions.text import split_lines, split_words

    return (rep.stream().select(F.explode(split_lines("text")).alias("line"))
            .select(F.explode(split_words("line")).alias("word")))


@query("resume_word_count", covers=("X1", "X2", "X3", "A4", "B5"), oracle=_oracle("word_count"))
def resume_word_count(spark, sf_dir):
    """Word count in update mode over documents replayed in ranges; the query
    is stopped after each range and restarted on the same checkpoint. Final
    totals equal one uninterrupted run."""
    docs = S.table(spark, sf_dir, "documents").select("doc_id", "text")
    rep = SS.Replay(spark, "wc", docs.schema, SS.arrival_ranges(docs, "doc_id", 2))
    counts = _word_stream(rep).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    out = RUN.replay_update([rep], counts, "wc", restarts=True)
    return RUN.latest_per_key(spark, out, ["word"], counts.schema)


#: Ranges of the documents, and the batch whose state the second query starts from.
SAVEPOINT_RANGES, SAVEPOINT_BATCH = 4, 1
#: Bytes of text for each distinct word, at least (sf0.1: 55).
SAVEPOINT_BYTES_PER_WORD = 32


@query("savepoint_word_count", covers=("X1", "X2", "X3"), oracle=_oracle("word_count"))
def savepoint_word_count(spark, sf_dir):
    """A first query counts the words of all ranges. A second one, with another
    plan (words counted within each task first, a processor in place of the
    built-in aggregate, twice the state partitions), starts from the state that the first
    one's checkpoint retains of an older batch and takes the ranges after it.
    The totals, read from the second query's state, equal one count."""
    docs = S.table(spark, sf_dir, "documents").select("doc_id", "text")
    ranges = SS.arrival_ranges(docs, "doc_id", SAVEPOINT_RANGES)
    whole = SS.Replay(spark, "savepoint-all", docs.schema, ranges)
    first = work_dir(spark, "stream-ckpt", "savepoint-first")
    counts = _word_stream(whole).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    RUN.feed_all([whole])
    RUN.run_batches(counts, "savepoint-first", lambda batch, no: batch.write.format("noop").mode("overwrite").save(), first, "update")

    start = SP.state_at(spark, first, SAVEPOINT_BATCH).select("key.word", F.col("value.count").alias("cnt"))
    after = SS.Ranges(ranges[SAVEPOINT_BATCH + 1:])
    after.files = ranges.files
    parts = B.part_count(spark, ranges.bytes // SAVEPOINT_BYTES_PER_WORD)
    rest = SS.Replay(spark, "savepoint-rest", docs.schema, after)
    second = work_dir(spark, "stream-ckpt", "savepoint-second")
    RUN.feed_all([rest])
    RUN.run_batches(SP.resume_counts(_word_stream(rest), start, parts), "savepoint-second",
                    lambda batch, no: batch.write.format("noop").mode("overwrite").save(), second, "update",
                    partitions=2 * RUN.state_partition_count(spark))
    return SP.state_at(spark, second, variable="count").select("key.word", F.col("value.cnt").alias("cnt"))


@query("stream_sql_select", covers=("S8", "S9", "B6", "B7"), oracle=_oracle("table_select_where"))
def stream_sql_select(spark, sf_dir):
    """Stream -> temporary view -> SQL -> insert-only stream (append sink)."""
    rep = replayed_events(spark, sf_dir, "sql-select", sentinel=False)
    event_stream(rep).createOrReplaceTempView("click_stream")
    sel = spark.sql("SELECT user_id, event_type, ts FROM click_stream WHERE event_type = 'view'")
    return _ntz(RUN.replay_append([rep], sel, "sql_select"), "ts")


@query("stream_sql_group_count", covers=("A5", "S11"), oracle="""
SELECT user_id, count(0) AS cnt FROM events GROUP BY user_id
""")
def stream_sql_group_count(spark, sf_dir):
    """Stream -> temporary view -> SQL aggregate -> update-mode sink: the
    latest row per key of the changelog is the table."""
    rep = replayed_events(spark, sf_dir, "sql-group", sentinel=False)
    event_stream(rep).createOrReplaceTempView("grouped_clicks")
    counts = spark.sql("SELECT user_id, count(0) AS cnt FROM grouped_clicks GROUP BY user_id")
    return RUN.latest_per_key(spark, RUN.replay_update([rep], counts, "sql_group"), ["user_id"], counts.schema)
