"""Queries over the driver tables: late data, joins, patterns, timers,
buffered sinks and physical distribution."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbflow.functions.time import epoch_us, from_epoch_seconds
from ebbflow.operators import eventtime as T
from ebbflow.operators import joins as J
from ebbflow.operators import partitioning as K
from ebbflow.operators import patterns as P
from ebbflow.operators.process import distinct_timers, with_task_index
from ebbflow.operators.state_machine import LOGIN_FAILURE_MACHINE, run_state_machine
from ebbflow.plans.catalog import query
from ebbflow.sources import tables as S

_EPOCH = "TIMESTAMP '1970-01-01'"

# ------------------------------------------------------------ T7-T9, W7 ---
# Arrival order derived from the table (events arrive up to 90 min late):
# arrival = ts + ((event_id * 7919) mod 5400) s, ties by event_id.
# Window 10 min, out-of-orderness bound 10 min, allowed lateness 30 min.


def arrivals(spark, sf_dir):
    ev = S.events(spark, sf_dir)
    delay = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                               ((F.col("event_id") * 7919) % 5400).cast("decimal(18,6)"))
    return ev.select("event_id", "user_id", "ts", (F.col("ts") + delay).alias("arrival"))


def tagged_arrivals(spark, sf_dir):
    return T.tag_lateness(arrivals(spark, sf_dir), "ts", ["arrival", "event_id"],
                          "10 minutes", "10 minutes", "30 minutes")


_ARRIVAL_SQL = f"""
a AS (SELECT event_id, user_id, ts,
             ts + to_seconds(CAST((event_id * 7919) % 5400 AS BIGINT)) AS arrival
      FROM events),
m AS (SELECT *, max(ts) OVER (ORDER BY arrival, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                - INTERVAL '10 minutes' AS watermark,
             time_bucket(INTERVAL '10 minutes', ts, {_EPOCH}) AS window_start
      FROM a),
t AS (SELECT *, window_start + INTERVAL '10 minutes' AS window_end,
             CASE WHEN watermark IS NULL OR watermark < window_start + INTERVAL '10 minutes'
                  THEN 'on_time'
                  WHEN watermark < window_start + INTERVAL '40 minutes' THEN 'late_update'
                  ELSE 'late' END AS status
      FROM m)
"""


@query("watermark_trace", covers=("T7", "T1", "T3", "T5"), oracle=f"""
WITH {_ARRIVAL_SQL}
SELECT event_id, user_id, ts, arrival, watermark FROM m
""")
def watermark_trace(spark, sf_dir):
    return T.with_watermark_trace(arrivals(spark, sf_dir), "ts", ["arrival", "event_id"],
                                  "10 minutes")


@query("late_main", covers=("T8", "W7", "A15", "S13"), oracle=f"""
WITH {_ARRIVAL_SQL}
SELECT user_id, window_start, window_end, count(*) AS cnt,
       CAST(sum(CASE WHEN status = 'late_update' THEN 1 ELSE 0 END) AS BIGINT) AS late_rows
FROM t WHERE status <> 'late' GROUP BY user_id, window_start, window_end
""")
def late_main(spark, sf_dir):
    return T.late_main(tagged_arrivals(spark, sf_dir), ["user_id"])


@query("late_side", covers=("T9", "S13"), oracle=f"""
WITH {_ARRIVAL_SQL}
SELECT event_id, user_id, ts, arrival, watermark, window_start, window_end
FROM t WHERE status = 'late'
""")
def late_side(spark, sf_dir):
    return T.late_side(tagged_arrivals(spark, sf_dir))


# -------------------------------------------------------------- J1-J3 ---

@query("connect_join", covers=("J1", "F4", "G2"), oracle="""
SELECT o.o_orderkey AS key,
       CASE WHEN l.l_shipdate >= o.o_orderdate THEN 'stream-2' ELSE 'stream-1' END AS emitted_by,
       CASE WHEN l.l_shipdate >= o.o_orderdate THEN l.l_shipdate ELSE o.o_orderdate END
         AS arriving_ts,
       CASE WHEN l.l_shipdate >= o.o_orderdate THEN o.o_orderdate ELSE l.l_shipdate END
         AS stored_ts,
       l.l_linenumber
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
""")
def connect_join(spark, sf_dir):
    # Re-aimed from "every view x every purchase of a user" (all pairs inside a
    # key) to orders x line items: the same full-history connect join, where
    # one side has one row per key so the output is linear in the input.
    orders = S.table(spark, sf_dir, "orders")
    items = S.table(spark, sf_dir, "lineitem")
    return J.connect_join(orders, items, "o_orderkey", "l_orderkey", "o_orderdate",
                          "l_shipdate", extra_r=["l_linenumber"])


@query("interval_join", covers=("J2", "F6"), oracle="""
SELECT v.user_id, v.event_id AS view_id, v.ts AS view_ts,
       p.event_id AS purchase_id, p.ts AS purchase_ts
FROM events v JOIN events p
  ON v.user_id = p.user_id
 AND p.ts BETWEEN v.ts - INTERVAL '6 hours' AND v.ts + INTERVAL '6 hours'
WHERE v.event_type = 'view' AND p.event_type = 'purchase'
""")
def interval_join(spark, sf_dir):
    ev = S.events(spark, sf_dir)
    views = ev.filter(F.col("event_type") == "view").select(
        "user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"))
    buys = ev.filter(F.col("event_type") == "purchase").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts"))
    return J.interval_join(views, buys, "user_id", "view_ts", "purchase_ts",
                           -6 * 3_600_000, 6 * 3_600_000)


@query("broadcast_rules", covers=("J3",), oracle="""
WITH l AS (SELECT user_id, event_id, event_type,
                  lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS prev_action
           FROM events)
SELECT user_id, event_id, prev_action, event_type FROM l
WHERE prev_action = 'signup' AND event_type = 'purchase'
""")
def broadcast_rules(spark, sf_dir):
    # The rule stream holds one rule here; in single-rule mode only the most
    # recently read rule is in force (J.latest_rule).
    rules = spark.createDataFrame([(0, "signup", "purchase")], "seq long, action1 string, action2 string")
    return J.broadcast_rules(S.events(spark, sf_dir), J.latest_rule(rules, "seq"),
                             "user_id", "event_type", "event_id")


# -------------------------------------------------------------- C1-C7 ---

_THREE_ERRORS_SQL = """
WITH o AS (
  SELECT user_id, event_id, ts, event_type,
         lag(event_type, 1) OVER w AS e1, lag(event_type, 2) OVER w AS e2,
         lag(ts, 1) OVER w AS p1, lag(ts, 2) OVER w AS p2
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, p2 AS {a}_ts, p1 AS {b}_ts, ts AS {c}_ts FROM o
WHERE event_type = 'error' AND e1 = 'error' AND e2 = 'error'
"""


@query("cep_next_chain", covers=("C1", "C7"),
       oracle=_THREE_ERRORS_SQL.format(a="first", b="second", c="third"))
def cep_next_chain(spark, sf_dir):
    fail = F.col("event_type") == "error"
    pat = P.Pattern.begin("first", fail).next("second", fail).next("third", fail)
    return P.strict_matches(S.events(spark, sf_dir), pat, "user_id", ["ts", "event_id"], ["ts"])


@query("cep_times_consecutive", covers=("C2", "C3", "C7"),
       oracle=_THREE_ERRORS_SQL.format(a="fail1", b="fail2", c="fail3"))
def cep_times_consecutive(spark, sf_dir):
    pat = P.Pattern.begin("fail", F.col("event_type") == "error").times(3)
    return P.strict_matches(S.events(spark, sf_dir), pat, "user_id", ["ts", "event_id"], ["ts"])


@query("state_machine", covers=("C6", "G1"), oracle="""
WITH o AS (
  SELECT user_id, event_id, ts, event_type,
         lag(event_type, 1) OVER w AS e1, lag(event_type, 2) OVER w AS e2
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, event_id, ts FROM o
WHERE event_type = 'error' AND e1 = 'error' AND e2 = 'error'
""")
def state_machine(spark, sf_dir):
    ev = S.events(spark, sf_dir).withColumn(
        "event", F.when(F.col("event_type") == "error", F.lit("fail"))
                  .when(F.col("event_type") == "purchase", F.lit("success"))
                  .otherwise(F.col("event_type")))
    return run_state_machine(ev, LOGIN_FAILURE_MACHINE, "user_id", ["ts", "event_id"],
                             "event", ["event_id", "ts"])


_ORDER_SQL = """
WITH s AS (
  SELECT user_id, event_id, ts, event_type,
         min(CASE WHEN event_type = 'purchase' THEN ts END) OVER (
           PARTITION BY user_id ORDER BY ts, event_id
           ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_pay
  FROM events WHERE event_type IN ('signup', 'purchase'))
"""


def _order_pattern(spark, sf_dir):
    pat = (P.Pattern.begin("create", F.col("event_type") == "signup")
           .followed_by("pay", F.col("event_type") == "purchase").within("12 hours"))
    return P.followed_by_within(S.events(spark, sf_dir), pat, "user_id", "ts", "event_id",
                                ["event_id"])


@query("cep_followed_by", covers=("C4", "C7"), oracle=_ORDER_SQL + """
SELECT user_id, event_id AS create_event_id, ts AS create_ts, next_pay AS pay_ts FROM s
WHERE event_type = 'signup' AND next_pay IS NOT NULL AND next_pay < ts + INTERVAL '12 hours'
""")
def cep_followed_by(spark, sf_dir):
    m = _order_pattern(spark, sf_dir)
    return m.filter(F.col("status") == "matched").select(
        "user_id", "create_event_id", "create_ts", "pay_ts")


@query("cep_timeout", covers=("C5", "S13"), oracle=_ORDER_SQL + """
SELECT user_id, event_id AS create_event_id, ts AS create_ts FROM s
WHERE event_type = 'signup' AND (next_pay IS NULL OR next_pay >= ts + INTERVAL '12 hours')
""")
def cep_timeout(spark, sf_dir):
    m = _order_pattern(spark, sf_dir)
    return m.filter(F.col("status") == "timeout").select("user_id", "create_event_id", "create_ts")


# ------------------------------------------------------- F2, S12, K2-K7 ---

@query("event_timers", covers=("F2",),
       oracle="SELECT DISTINCT ts + INTERVAL '3 seconds' AS timer_ts FROM events")
def event_timers(spark, sf_dir):
    return distinct_timers(S.events(spark, sf_dir), "ts", "3 seconds")


@query("buffered_sink", covers=("S12", "G7"), oracle="""
WITH p AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS pos FROM events),
n AS (SELECT count(*) AS c FROM events)
SELECT event_id, CAST(pos // 10 AS BIGINT) AS batch_no FROM p, n WHERE pos // 10 < n.c // 10
""")
def buffered_sink(spark, sf_dir):
    from ebbflow.sinks.buffered import full_groups
    return full_groups(S.events(spark, sf_dir).select("event_id"), "event_id", 10)


@query("repartition_modes", covers=("K2", "K3", "K4", "K5", "K6", "K7"), oracle="""
SELECT m.mode, CAST(CASE WHEN m.raw THEN n.c ELSE n.types END AS BIGINT) AS rows
FROM (SELECT count(*) AS c, count(DISTINCT event_type) + max(CASE WHEN event_type IS NULL THEN 1 ELSE 0 END) AS types FROM events) n,
     (VALUES ('shuffle', true), ('rebalance', true), ('rescale', true), ('broadcast', false),
             ('global', false), ('custom', true)) m(mode, raw)
""")
def repartition_modes(spark, sf_dir):
    return K.partition_report(S.events(spark, sf_dir).select("event_id", "user_id", "event_type"),
                              "user_id", "event_type")


@query("periodic_pv", covers=("F3", "G1"), oracle="""
WITH RECURSIVE chain(user_id, s) AS (
  SELECT user_id, min(ts) FROM events GROUP BY user_id
  UNION ALL
  SELECT c.user_id, min(e.ts) FROM chain c JOIN events e
    ON e.user_id = c.user_id AND e.ts > c.s + INTERVAL '10 hours'
  GROUP BY c.user_id
)
SELECT c.user_id, c.s + INTERVAL '10 hours' AS timer_ts,
       (SELECT count(*) FROM events e
        WHERE e.user_id = c.user_id AND e.ts <= c.s + INTERVAL '10 hours') AS cnt
FROM chain c
""")
def periodic_pv(spark, sf_dir):
    from ebbflow.operators.process import periodic_counts
    return periodic_counts(S.events(spark, sf_dir), "user_id", "ts", "10 hours")


@query("seconds_to_event_time", covers=("T2",), oracle="""
SELECT event_id, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS event_time FROM events
""")
def seconds_to_event_time(spark, sf_dir):
    """Records that carry epoch seconds get an event time."""
    sec = F.floor(epoch_us("ts") / 1_000_000).cast("long")
    return S.events(spark, sf_dir).select("event_id", sec.alias("sec")).select("event_id", from_epoch_seconds("sec").alias("event_time"))


@query("process_records", covers=("F1", "T7"), oracle=f"""
WITH {_ARRIVAL_SQL}
SELECT event_id, user_id, ts, watermark, true AS has_task FROM m
""")
def process_records(spark, sf_dir):
    """Every record with its time, the watermark it met and the task that
    handles it (which task is up to the run; that there is one is checked)."""
    traced = T.with_watermark_trace(arrivals(spark, sf_dir), "ts", ["arrival", "event_id"], "10 minutes")
    return with_task_index(traced).select("event_id", "user_id", "ts", "watermark", (F.col("task") >= 0).alias("has_task"))
