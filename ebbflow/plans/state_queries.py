"""Streaming queries with keyed state and timers (transformWithState) and
the streaming buffered sink. Each carries the oracle of the batch query it
must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.functions.time import as_event_time, duration_ms, epoch_us
from ebbflow.operators import running as R
from ebbflow.operators.state_machine import LOGIN_FAILURE_MACHINE
from ebbflow.plans.catalog import query
from ebbflow.plans.stream_queries import SENTINEL_ID, _oracle, event_stream, replayed_events
from ebbflow.sinks.console import printed
from ebbflow.sources import tables as S
from ebbflow.streaming import blocks as B
from ebbflow.streaming import chained as CH
from ebbflow.streaming import chunked as CK
from ebbflow.streaming import connected as CO
from ebbflow.streaming import processors as PR
from ebbflow.streaming import runner as RUN
from ebbflow.streaming import sources as SS
from ebbflow.streaming import ttl as TTL
from ebbflow.streaming.sinks import run_buffered, run_fan_out

#: Watermark bound of the keyed queries: ranges are fed in order of event time.
BOUND = "0 seconds"


def _ts(col: str):
    return F.timestamp_micros(F.col(col)).cast("timestamp_ntz")


def _us(spec: str) -> int:
    return duration_ms(spec) * 1000


def _delay_us(spark, sf_dir, bound: str) -> int:
    """The declared delay behind which no event of the table can be, in whole
    seconds (Spark keeps the watermark in milliseconds)."""
    span = SS.event_span_us(S.events(spark, sf_dir), "ts") + _us(bound)
    return (span // 1_000_000 + 1) * 1_000_000


def _rows(rep, key, value):
    return PR.keyed_rows(event_stream(rep), key, "ts", "event_id", value)


def ordered_stream(spark, sf_dir, name, logic, key="user_id", value=None, bound=BOUND, replay=None, hot=None):
    """The input, and the stream of all output, of ``logic`` over the events in
    order of event time; the tag is ``main`` or ``late`` (rows that came too
    late to be put in order). ``hot``: keys that are folded by buckets of time
    (None: those with a large share of all events)."""
    delay = _delay_us(spark, sf_dir, bound)
    rep = replay or replayed_events(spark, sf_dir, name)
    hot = CO.hot_keys(S.events(spark, sf_dir), key) if hot is None else hot
    rows = PR.widened(_rows(rep, F.col(key), F.col("event_type") if value is None else value), "ts", delay)
    return rep, CK.ordered_fold(rows, logic, _us(bound), delay, hot=hot, parts=B.part_count(spark, rep.rows))


def ordered(spark, sf_dir, name, logic, **kw) -> DataFrame:
    rep, out = ordered_stream(spark, sf_dir, name, logic, **kw)
    return RUN.replay_append([rep], out, name)


def _before_flush(us: str):
    """Rows of real events, whatever their key: the flush row is told by its time."""
    return _ts(us) < F.lit(SS.SENTINEL_TS).cast("timestamp_ntz")


def _main(out: DataFrame) -> DataFrame:
    return out.filter((F.col("tag") == "main") & _before_flush("us"))


def arrived(spark, sf_dir, name, logic, ttl_ms=None) -> DataFrame:
    """All output of ``logic`` over the events in order of arrival."""
    rep = replayed_events(spark, sf_dir, name, sentinel=False, order="event_id")
    rows = _rows(rep, F.col("user_id"), F.col("event_type")).drop("ts")
    out = rows.groupBy("key").transformWithState(PR.ArrivalProcessor(logic, ttl_ms), PR.output_schema("long"), "Append",
                                                 "ProcessingTime" if ttl_ms else "None")
    return RUN.replay_append([rep], out, name, until_caught_up=bool(ttl_ms))


# ---------------------------------------------------- order of event time ---

@query("stream_state_machine", covers=("C6", "C7", "G1", "G2"), oracle=_oracle("state_machine"))
def stream_state_machine(spark, sf_dir):
    event = (F.when(F.col("event_type") == "error", F.lit("fail"))
              .when(F.col("event_type") == "purchase", F.lit("success"))
              .otherwise(F.col("event_type")))
    out = _main(ordered(spark, sf_dir, "state-machine", PR.MachineLogic(LOGIN_FAILURE_MACHINE), value=event))
    return out.select(F.col("key").alias("user_id"), F.col("seq").alias("event_id"), _ts("us").alias("ts"))


@query("stream_cep_times", covers=("C1", "C2", "C3", "C7"), oracle=_oracle("cep_times_consecutive"))
def stream_cep_times(spark, sf_dir):
    out = _main(ordered(spark, sf_dir, "cep-times", PR.StrictLogic(["error"] * 3)))
    return out.select(F.col("key").alias("user_id"), _ts("a").alias("fail1_ts"), _ts("b").alias("fail2_ts"), _ts("us").alias("fail3_ts"))


def order_outputs(spark, sf_dir, replay=None) -> dict[str, DataFrame]:
    """Both results of the order pattern as two tables of one run."""
    rep, out = ordered_stream(spark, sf_dir, "orders", PR.FollowedByLogic("signup", "purchase", _us("12 hours")), replay=replay)

    def table(status):
        def pick(df):
            df = _main(df).filter(F.col("status") == status)
            got = df.select(F.col("key").alias("user_id"), F.col("seq").alias("create_event_id"), _ts("us").alias("create_ts"),
                            _ts("a").alias("pay_ts"))
            return got if status == "matched" else got.drop("pay_ts")
        return pick

    return run_fan_out([rep], out, "orders", {s: table(s) for s in ("matched", "timeout")})


@query("stream_cep_followed_by", covers=("C4",), oracle=_oracle("cep_followed_by"))
def stream_cep_followed_by(spark, sf_dir):
    return order_outputs(spark, sf_dir)["matched"]


@query("stream_cep_timeout", covers=("C5", "S13"), oracle=_oracle("cep_timeout"))
def stream_cep_timeout(spark, sf_dir):
    return order_outputs(spark, sf_dir)["timeout"]


@query("stream_cep_outputs", covers=("C4", "C5", "S13"), oracle=f"""
SELECT 'matched' AS output, user_id, create_event_id, create_ts, pay_ts FROM ({_oracle("cep_followed_by")})
UNION ALL
SELECT 'timeout', user_id, create_event_id, create_ts, CAST(NULL AS TIMESTAMP) FROM ({_oracle("cep_timeout")})
""")
def stream_cep_outputs(spark, sf_dir):
    """The two tables that one run of the pattern writes, side by side."""
    both = order_outputs(spark, sf_dir)
    tagged = [df.withColumn("output", F.lit(name)) for name, df in both.items()]
    return tagged[0].unionByName(tagged[1], allowMissingColumns=True)


@query("stream_periodic_pv", covers=("F3", "G1"), oracle=_oracle("periodic_pv"))
def stream_periodic_pv(spark, sf_dir):
    out = _main(ordered(spark, sf_dir, "periodic-pv", PR.PeriodicLogic(_us("10 hours"))))
    return out.select(F.col("key").alias("user_id"), _ts("us").alias("timer_ts"), F.col("a").alias("cnt"))


#: The few keys of the hand-built window are salted, and its windows held in
#: buckets of a day, which is part of the state's key.
WINDOW_SALTS, WINDOW_BUCKET = 4, "24 hours"


@query("stream_manual_window", covers=("W9", "G3"), oracle=_oracle("manual_window"))
def stream_manual_window(spark, sf_dir, bound=BOUND, replay=None):
    """Five event types hold all rows, so the processor's key is the day, a salt
    and the type; its partial counts add up to the window's."""
    delay = _delay_us(spark, sf_dir, bound)
    rep = replay or replayed_events(spark, sf_dir, "manual-window")
    rows = PR.widened(_rows(rep, F.col("event_type"), F.lit("")), "ts", delay)
    keys = {"day": PR.bucket_of(F.col("us"), _us(WINDOW_BUCKET)), "salt": F.pmod(F.xxhash64("seq"), F.lit(WINDOW_SALTS))}
    out = rows.withColumns(keys).groupBy("day", "salt", "key").transformWithState(
        PR.ManualWindowProcessor(_us("1 hour"), _us(bound), delay), "start_us long, end_us long, key string, cnt long", "Append", "EventTime")
    done = RUN.replay_append([rep], out, "manual-window").filter(_before_flush("start_us"))
    return (done.groupBy(_ts("start_us").alias("window_start"), _ts("end_us").alias("window_end"), F.col("key").alias("event_type"))
            .agg(F.sum("cnt").alias("cnt")))


#: Timers are held in buckets of due time, dealt to so many keys; equal times meet.
TIMER_BUCKET, TIMER_SALTS = "6 hours", 8


@query("stream_event_timers", covers=("F2", "G3"), oracle=_oracle("event_timers"))
def stream_event_timers(spark, sf_dir):
    delay = _delay_us(spark, sf_dir, BOUND)
    rep = replayed_events(spark, sf_dir, "event-timers")
    after = _us("3 seconds")
    rows = PR.widened(_rows(rep, F.pmod(F.xxhash64("ts"), F.lit(TIMER_SALTS)), F.lit("")), "ts", delay)
    rows = rows.withColumn("bucket", PR.bucket_of(F.col("us") + F.lit(after), _us(TIMER_BUCKET)))
    out = rows.groupBy("bucket", "key").transformWithState(PR.EventTimerProcessor(after, _us(BOUND), delay), "timer_us long", "Append", "EventTime")
    done = RUN.replay_append([rep], out, "event-timers")
    return done.filter(_before_flush("timer_us")).select(_ts("timer_us").alias("timer_ts"))


# ------------------------------------------------------- order of arrival ---

@query("stream_running_count", covers=("A2", "A7"), oracle="""
SELECT event_id, user_id, cnt, 'count：' || cnt AS label FROM (
  SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt FROM events)
""")
def stream_running_count(spark, sf_dir):
    out = arrived(spark, sf_dir, "running-count", PR.CountLogic())
    return out.select(F.col("seq").alias("event_id"), F.col("key").alias("user_id"), F.col("a").alias("cnt"), F.col("status").alias("label"))


@query("stream_running_keyed_max", covers=("A1", "G4"), oracle=_oracle("running_keyed_max"))
def stream_running_keyed_max(spark, sf_dir):
    out = arrived(spark, sf_dir, "running-max", PR.MaxLogic())
    return out.select(F.col("seq").alias("event_id"), F.col("key").alias("user_id"), F.col("v").alias("event_type"), _ts("us").alias("ts"))


@query("stream_count_window_avg", covers=("A9", "A10", "G5"), oracle=_oracle("count_window_avg"))
def stream_count_window_avg(spark, sf_dir):
    out = arrived(spark, sf_dir, "count-window-avg", PR.MeanLogic(10))
    return out.select(F.col("key").alias("user_id"), F.col("seq").alias("event_id"), F.col("a").alias("rn"), F.col("b").alias("avg_ts_ms"))


#: A user's count starts afresh after so long without events.
TTL_MS = 30 * 86_400_000


@query("state_ttl", covers=("G6",), oracle=_oracle("running_count"))
def state_ttl(spark, sf_dir, ttl_ms=TTL_MS):
    """Per-user counter whose state expires ``ttl_ms`` of processing time after
    its last change: here far longer than any run, so no count starts afresh
    (expiry has a test of its own)."""
    out = arrived(spark, sf_dir, "state-ttl", PR.CountLogic(), ttl_ms)
    return out.select(F.col("key").alias("user_id"), F.col("seq").alias("event_id"), F.col("a").alias("cnt"))


#: Ranges of actions that the rules are fed with.
RULE_RANGES = 8


def rules_oracle(ranges: int) -> str:
    """SQL for :func:`stream_broadcast_rules` over so many ranges."""
    return f"""
WITH kinds AS (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS no
               FROM events WHERE event_type IS NOT NULL GROUP BY event_type),
b AS (SELECT min(event_id) AS lo, max(event_id) AS hi, (SELECT max(no) FROM kinds) AS last FROM events),
a AS (SELECT user_id, event_id, event_type, ((event_id - lo) * {ranges}) // (hi - lo + 1) AS range_no, last,
             lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS prev_action FROM events, b)
SELECT user_id, event_id, prev_action, a.event_type
FROM a JOIN kinds k ON k.no = CASE WHEN range_no >= {ranges - 1} THEN last ELSE least(range_no, last) END
WHERE prev_action = k.event_type AND a.event_type = 'purchase'
"""


@query("stream_most_active_user", covers=("A3", "K1b"), oracle=_oracle("most_active_user"))
def stream_most_active_user(spark, sf_dir):
    """The leader after every event. The stream finds the rows that take the
    lead (a leader per bucket of users, then a leader of leaders); every event
    then takes the last of them up to itself."""
    rep = replayed_events(spark, sf_dir, "most-active", cols=("event_id", "user_id"), sentinel=False, order="event_id")
    rows = rep.stream().select(F.col("event_id").alias("seq"), F.col("user_id").alias("id"))
    buckets = 4 * RUN.state_partition_count(spark)
    changes = RUN.replay_append([rep], CH.leader_changes(rows, buckets), "most-active")
    ev = S.events(spark, sf_dir).select("event_id")
    led = ev.join(changes.select(F.col("seq").alias("event_id"), F.struct("cnt", "seq", "id").alias("lead")), "event_id", "left")
    last = R.running(led, [], ["event_id"], {"_lead": R.rmax(F.col("lead"))})
    return last.select("event_id", F.col("_lead.id").alias("leader_user_id"), F.col("_lead.cnt").alias("leader_cnt"))


#: Ranges, and the life of a user's count, of the query below.
TTL_RANGES, TTL_HOURS = 8, 12


def ttl_oracle(ranges: int, hours: int) -> str:
    return f"""
WITH b AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
e AS (SELECT event_id, user_id, epoch_us(ts) AS us, ((epoch_us(ts) - lo) * {ranges}) // (hi - lo + 1) AS no FROM events, b),
top AS (SELECT no, max(us) // 1000 AS ms FROM e GROUP BY no),
-- the watermark a batch meets, left by the batches before it
met AS (SELECT n.no, (SELECT max(ms) FROM top WHERE top.no < n.no) AS ms FROM (SELECT DISTINCT no FROM e) n),
p AS (SELECT *, lag(us) OVER w AS last_us, lag(no) OVER w AS last_no FROM e
      WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
f AS (SELECT p.*, CASE
        WHEN last_us IS NULL THEN 'first'
        WHEN EXISTS (SELECT 1 FROM met WHERE met.no >= last_no AND met.no < p.no AND met.ms * 1000 >= last_us + {hours} * 3600000000) THEN 'first'
        WHEN us - last_us > {hours} * 3600000000 THEN 'stale' ELSE 'live' END AS found FROM p),
g AS (SELECT *, sum(CASE WHEN found = 'first' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY us, event_id
        ROWS UNBOUNDED PRECEDING) AS life FROM f)
SELECT user_id, event_id, found, count(*) OVER (PARTITION BY user_id, life ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS cnt FROM g
"""


@query("stream_ttl_visible", covers=("G6",), oracle=ttl_oracle(TTL_RANGES, TTL_HOURS))
def stream_ttl_visible(spark, sf_dir, ranges=TTL_RANGES, hours=TTL_HOURS):
    """Per-user counts that live for ``hours`` after their last write, on the
    events' own clock: an expired count is still read (``stale``) until it has
    been cleaned, then the user starts afresh (``first``)."""
    ev = S.events(spark, sf_dir).select("event_id", "user_id", "event_type", "ts")
    rep = SS.Replay(spark, "ttl-visible", ev.schema, SS.arrival_ranges(ev, "ts", ranges, even_rows=False))
    rows = _rows(rep, F.col("user_id"), F.col("event_type")).withWatermark("ts", "0 seconds")
    out = rows.groupBy("key").transformWithState(TTL.VisibleTtl(_us(f"{hours} hours")), "key long, seq long, cnt long, found string", "Append", "EventTime")
    done = RUN.replay_append([rep], out, "ttl-visible")
    return done.select(F.col("key").alias("user_id"), F.col("seq").alias("event_id"), "found", "cnt")


@query("stream_broadcast_rules", covers=("J3", "F5", "G8"), oracle=rules_oracle(RULE_RANGES))
def stream_broadcast_rules(spark, sf_dir, ranges=RULE_RANGES):
    """Two streams in one query: actions, and rules (previous action, action) of
    which the latest is in force, as broadcast state. The i-th event type
    followed by a purchase is a rule; rule i arrives with the i-th range of
    actions and is met before it, rules beyond the last range arrive with that."""
    ev = S.events(spark, sf_dir).select("event_id", "user_id", "event_type")
    # event types are a small set
    kinds = ev.agg(F.sort_array(F.collect_set("event_type")).alias("kinds")).select(F.posexplode("kinds").alias("rule_no", "before"))
    numbered = kinds.withColumn("now", F.lit("purchase"))
    actions = SS.Replay(spark, "rule-actions", ev.schema, SS.arrival_ranges(ev, "event_id", ranges, even_rows=False))
    rules = SS.Replay(spark, "rules", numbered.schema,
                      [numbered.filter(F.least(F.col("rule_no"), F.lit(len(actions.frames) - 1)) == i) for i in range(len(actions.frames))])
    parts = B.part_count(spark, actions.rows)
    hits = CO.with_rules(actions.stream().select(F.col("user_id").alias("id"), F.col("event_id").alias("action_no"), F.col("event_type").alias("now")),
                         rules.stream(), parts)
    done = RUN.replay_append([rules, actions], hits, "broadcast-rules")
    return done.select(F.col("id").alias("user_id"), F.col("action_no").alias("event_id"), F.col("before").alias("prev_action"),
                       F.col("now").alias("event_type"))


#: Ranges of the two inputs of the connected streams.
PAIR_RANGES = 4


@query("stream_two_inputs", covers=("F4", "J1", "G2"), oracle=f"""
SELECT c_custkey AS cust_key, o_orderkey AS order_key,
       CASE WHEN (o_orderkey * 7) % {PAIR_RANGES} >= (c_custkey * 3) % {PAIR_RANGES} THEN 'stream-2' ELSE 'stream-1' END AS emitted_by
FROM customer JOIN orders ON c_custkey = o_custkey
""")
def stream_two_inputs(spark, sf_dir, hot=None, salts=16):
    """Customers (stream 1) and their orders (stream 2) connected by key: each
    pair comes out once, from the row that arrives later. A row's range is a
    rule on its id, so customers arrive before, between and after their orders."""
    people = S.table(spark, sf_dir, "customer").select("c_custkey")
    orders = S.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    number = lambda col, by: F.pmod(F.col(col) * F.lit(by), F.lit(PAIR_RANGES))
    one = SS.Replay(spark, "pair-people", people.schema, SS.staged_ranges(people, number("c_custkey", 3), PAIR_RANGES))
    two = SS.Replay(spark, "pair-orders", orders.schema, SS.staged_ranges(orders, number("o_orderkey", 7), PAIR_RANGES))
    hot = CO.hot_keys(orders, "o_custkey") if hot is None else hot
    rows = lambda df, key, ref: df.select(F.col(key).cast("long").alias("key"), F.col(ref).cast("long").alias("seq"), F.col(ref).cast("long").alias("ref"))
    pairs = CO.connect(rows(one.stream(), "c_custkey", "c_custkey"), rows(two.stream(), "o_custkey", "o_orderkey"), hot=hot, salts=salts,
                       parts=B.part_count(spark, one.rows + two.rows))
    done = RUN.replay_append([one, two], pairs, "two-inputs")
    later = F.col("emitted_by") == "stream-2"
    return done.select(F.col("key").alias("cust_key"), F.when(later, F.col("arriving")).otherwise(F.col("stored")).alias("order_key"), "emitted_by")


@query("stream_buffered_sink", covers=("S12", "G7"), oracle="""
WITH p AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS pos FROM events),
n AS (SELECT count(*) AS c FROM events)
SELECT event_id, CASE WHEN pos // 10 < n.c // 10 THEN CAST(pos // 10 AS BIGINT) END AS batch_no FROM p, n
""")
def stream_buffered_sink(spark, sf_dir):
    """Full groups of ten, and the rows still pending (no ``batch_no``)."""
    rep = replayed_events(spark, sf_dir, "buffered", cols=("event_id",), sentinel=False, order="event_id")
    return run_buffered(rep, "event_id", 10, "buffered", with_pending=True)


@query("stream_window_sequence", covers=("W8", "F7"), oracle=_oracle("window_sequence"))
def stream_window_sequence(spark, sf_dir):
    rep = replayed_events(spark, sf_dir, "window-sequence")
    ev = event_stream(rep).withWatermark("ts", BOUND)
    out = RUN.replay_append([rep], CH.window_sequence(ev, "ts", "3 hours", "user_id"), "window-sequence")
    return out.select(F.col("key").alias("user_id"), *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")], "cnt", "window_no")


@query("stream_print", covers=("S10", "S13"), oracle=f"""
SELECT 'matched' AS tag, 'matched> (' || coalesce(CAST(user_id AS VARCHAR), 'null') || ', ' || create_event_id || ')' AS line
FROM ({_oracle("cep_followed_by")})
UNION ALL
SELECT 'timeout', 'timeout> (' || coalesce(CAST(user_id AS VARCHAR), 'null') || ', ' || create_event_id || ')' FROM ({_oracle("cep_timeout")})
""")
def stream_print(spark, sf_dir):
    """Two outputs of one query, printed as lines under their prefixes."""
    rep, out = ordered_stream(spark, sf_dir, "print", PR.FollowedByLogic("signup", "purchase", _us("12 hours")))

    def rows(status):
        return lambda df: _main(df).filter(F.col("status") == status).select("key", "seq")
    return printed([rep], out, "print", {s: rows(s) for s in ("matched", "timeout")})


# ------------------------------------------------ T8/T9 on a stream (H1) ---
LATE_RANGES = 8
#: The windows of a part of the users are held in buckets of so much time (whole windows).
LATE_BUCKET = "240 hours"


@query("stream_late_data", covers=("T8", "T9", "W7", "S13", "T3", "T6"), oracle=f"""
WITH a AS (SELECT event_id, user_id, ts,
                  ts + to_seconds(CAST((event_id * 7919) % 5400 AS BIGINT)) AS arrival
           FROM events),
b AS (SELECT min(epoch_us(arrival)) AS lo, max(epoch_us(arrival)) AS hi FROM a),
f AS (SELECT a.*, ((epoch_us(arrival) - lo) * {LATE_RANGES}) // (hi - lo + 1) AS file_no,
             time_bucket(INTERVAL '10 minutes', ts, TIMESTAMP '1970-01-01') AS window_start
      FROM a, b),
w AS (SELECT file_no, max(mts) OVER (ORDER BY file_no ROWS BETWEEN UNBOUNDED PRECEDING
                                     AND 1 PRECEDING) - INTERVAL '10 minutes' AS wprev
      FROM (SELECT file_no, max(ts) AS mts FROM f GROUP BY file_no)),
t AS (SELECT f.*, window_start + INTERVAL '10 minutes' AS window_end,
             CASE WHEN wprev IS NULL OR wprev < window_start + INTERVAL '10 minutes' THEN 'on_time'
                  WHEN wprev < window_start + INTERVAL '40 minutes' THEN 'update'
                  ELSE 'late' END AS status
      FROM f JOIN w USING (file_no)),
o AS (SELECT user_id, window_start, count(*) AS ontime FROM t WHERE status = 'on_time'
      GROUP BY user_id, window_start)
SELECT 'main' AS tag, user_id, window_start, window_start + INTERVAL '10 minutes' AS window_end,
       ontime AS cnt, CAST(NULL AS BIGINT) AS event_id FROM o
UNION ALL
SELECT 'update', t.user_id, t.window_start, t.window_end,
       coalesce(o.ontime, 0) + row_number() OVER (PARTITION BY t.user_id, t.window_start
                                                  ORDER BY t.arrival, t.event_id),
       t.event_id
FROM t LEFT JOIN o ON o.user_id = t.user_id AND o.window_start = t.window_start
WHERE t.status = 'update'
UNION ALL
SELECT 'late', user_id, window_start, window_end, CAST(NULL AS BIGINT), event_id
FROM t WHERE status = 'late'
""")
def stream_late_data(spark, sf_dir):
    """Per-user 10-minute counts with a 10-minute out-of-orderness bound, 30
    minutes of allowed lateness and a side output, over the events replayed
    in arrival order (arrival = ts + ((event_id * 7919) mod 5400) s) as
    LATE_RANGES ranges. The oracle replays the same boundaries: a row
    meets the watermark left by the ranges before its own."""
    from ebbflow.plans.event_queries import arrivals
    from ebbflow.streaming.late import LateWindowProcessor

    arr = arrivals(spark, sf_dir)
    frames = SS.arrival_ranges(arr, "arrival", LATE_RANGES, even_rows=False)
    frames.append(SS.sentinel_frame(spark, {"event_id": SENTINEL_ID, "user_id": SENTINEL_ID,
                                            "ts": SS.SENTINEL_TS, "arrival": SS.SENTINEL_TS}, arr.schema))
    rep = SS.Replay(spark, "late-data", arr.schema, frames)
    delay = _delay_us(spark, sf_dir, "10 minutes")
    ev = PR.widened(rep.stream().withColumns({"ts": as_event_time("ts"), "us": epoch_us("ts"), "arr_us": epoch_us("arrival")}), "ts", delay)
    proc = LateWindowProcessor("us", "event_id", "arr_us", _us("10 minutes"), _us("10 minutes"), _us("30 minutes"), delay, "user_id")
    ev = ev.withColumns({"bucket": PR.bucket_of(F.col("us"), _us(LATE_BUCKET)), "part": B.part_of(B.part_count(spark, rep.rows), "user_id")})
    out = ev.groupBy("part", "bucket").transformWithState(
        proc, "tag string, key long, start_us long, end_us long, cnt long, seq long", "Append", "EventTime")
    res = RUN.replay_append([rep], out, "late-data")
    return res.filter(_before_flush("start_us")).select(
        "tag", F.col("key").alias("user_id"), _ts("start_us").alias("window_start"),
        _ts("end_us").alias("window_end"), "cnt", F.col("seq").alias("event_id"))


TRACE_RANGES = 6


@query("stream_watermark_trace", covers=("T7", "F1"), oracle=f"""
WITH a AS (SELECT event_id, user_id, ts,
                  ts + to_seconds(CAST((event_id * 7919) % 5400 AS BIGINT)) AS arrival
           FROM events),
b AS (SELECT min(epoch_us(arrival)) AS lo, max(epoch_us(arrival)) AS hi FROM a),
f AS (SELECT a.*, ((epoch_us(arrival) - lo) * {TRACE_RANGES}) // (hi - lo + 1) AS file_no
      FROM a, b),
w AS (SELECT file_no, max(mts) OVER (ORDER BY file_no ROWS BETWEEN UNBOUNDED PRECEDING
                                     AND 1 PRECEDING) AS wmax
      FROM (SELECT file_no, max(ts) AS mts FROM f GROUP BY file_no))
SELECT f.event_id, f.user_id,
       make_timestamp((epoch_us(w.wmax) // 1000) * 1000) - INTERVAL '10 minutes' AS watermark
FROM f JOIN w USING (file_no)
""")
def stream_watermark_trace(spark, sf_dir):
    """Each event, replayed in arrival order as TRACE_RANGES ranges, with the
    watermark (10-minute bound) it met in its micro-batch. Spark keeps the
    watermark in milliseconds, so the oracle truncates the same way."""
    from ebbflow.plans.event_queries import arrivals
    from ebbflow.streaming.late import WatermarkTraceProcessor

    arr = arrivals(spark, sf_dir)
    rep = SS.Replay(spark, "wm-trace", arr.schema, SS.arrival_ranges(arr, "arrival", TRACE_RANGES, even_rows=False))
    delay = _delay_us(spark, sf_dir, "10 minutes")
    ev = PR.widened(rep.stream().withColumns({"ts": as_event_time("ts"), "spread": F.pmod(F.xxhash64("event_id"), F.lit(256))}), "ts", delay)
    proc = WatermarkTraceProcessor("event_id", "user_id", _us("10 minutes"), delay)
    out = ev.groupBy("spread").transformWithState(proc, "key long, seq long, wm_us long", "Append", "EventTime")
    res = RUN.replay_append([rep], out, "wm-trace")
    return res.select(F.col("seq").alias("event_id"), F.col("key").alias("user_id"),
                      _ts("wm_us").alias("watermark"))
