"""Queries over the driver tables: sources, projections, aggregates, windows.

Mapping of the original records onto ``events`` (SURVEY §7.3): a click is
(``user_id``, ``event_type`` as the url, ``ts``); ``event_id`` is the arrival
sequence.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbflow.functions.text import split_lines, split_words
from ebbflow.functions.time import epoch_ms
from ebbflow.operators import aggregates as A
from ebbflow.operators import basic as B
from ebbflow.operators import windows as W
from ebbflow.plans.catalog import query
from ebbflow.sources import tables as S

# DuckDB has no epoch-aligned sliding window: a row belongs to the windows
# starting at its slide bucket and the (size/slide - 1) buckets before it.
_EPOCH = "TIMESTAMP '1970-01-01'"


# ---------------------------------------------------------------- B1-B8 ---

@query("map_project", covers=("B1", "S1"),
       oracle="SELECT user_id FROM events")
def map_project(spark, sf_dir):
    return B.project(S.events(spark, sf_dir), "user_id")


@query("filter_eq", covers=("B2",),
       oracle="SELECT * FROM events WHERE event_type = 'purchase'")
def filter_eq(spark, sf_dir):
    return B.filter_eq(S.events(spark, sf_dir), "event_type", "purchase")


@query("flatmap_fields", covers=("B3",), oracle="""
SELECT event_id, 0::BIGINT AS pos, CAST(user_id AS VARCHAR) AS field FROM events
UNION ALL SELECT event_id, 1::BIGINT, event_type FROM events
UNION ALL SELECT event_id, 2::BIGINT, CAST((epoch_us(ts) // 1000) AS VARCHAR) FROM events
""")
def flatmap_fields(spark, sf_dir):
    return B.flatmap_fields(S.events(spark, sf_dir), "event_id",
                            ["user_id", "event_type", epoch_ms("ts")])


@query("sql_select", covers=("B6", "S8", "S9"),
       oracle="SELECT user_id, event_type, ts FROM events")
def sql_select(spark, sf_dir):
    return B.sql_select(spark, S.events(spark, sf_dir), "click_events",
                        ["user_id", "event_type", "ts"])


@query("table_select_where", covers=("B7",),
       oracle="SELECT user_id, event_type, ts FROM events WHERE event_type = 'view'")
def table_select_where(spark, sf_dir):
    return B.select_where(S.events(spark, sf_dir), ["user_id", "event_type", "ts"],
                          "event_type", "view")


@query("table_view_chain", covers=("B8", "S7"),
       oracle="SELECT user_id, event_id FROM events WHERE event_type = 'view'")
def table_view_chain(spark, sf_dir):
    return B.view_chain(spark, S.events(spark, sf_dir), "event_type", "view",
                        ["user_id", "event_id"], "view_events")


# ------------------------------------------------------------- S2-S6, S11 ---

@query("csv_parse", covers=("S2", "S3"),
       oracle="SELECT user_id, event_id, event_type, (epoch_us(ts) // 1000) AS ts_ms FROM events")
def csv_parse(spark, sf_dir):
    path = S.staged_click_csv(spark, sf_dir)
    return S.read_csv(spark, path, S.CLICK_LINE_SCHEMA)


@query("csv_lines_parse", covers=("S2", "S3"),
       oracle="SELECT user_id, event_id, event_type, (epoch_us(ts) // 1000) AS ts_ms FROM events")
def csv_lines_parse(spark, sf_dir):
    path = S.staged_click_csv(spark, sf_dir)
    return S.parse_lines(S.read_lines(spark, path), S.CLICK_LINE_SCHEMA)


@query("sql_csv_table", covers=("S5", "S6"), oracle="""
SELECT CAST(user_id AS VARCHAR) AS userid, CAST(event_id AS VARCHAR) AS itemid,
       event_type AS behavior, CAST((epoch_us(ts) // 1000) AS VARCHAR) AS ts
FROM events
""")
def sql_csv_table(spark, sf_dir):
    path = S.staged_click_csv(spark, sf_dir)
    return S.register_csv_table(spark, "click_table", path,
                                "userid STRING, itemid STRING, behavior STRING, ts STRING")


@query("sql_group_count", covers=("A5", "S11"), oracle="""
SELECT CAST(user_id AS VARCHAR) AS userid, count(0) AS cnt FROM events GROUP BY user_id
""")
def sql_group_count(spark, sf_dir):
    from ebbflow.sinks.tables import insert_query
    path = S.staged_click_csv(spark, sf_dir)
    S.register_csv_table(spark, "click_table", path,
                         "userid STRING, itemid STRING, behavior STRING, ts STRING")
    return insert_query(spark, "out_table", "userid STRING, cnt BIGINT",
                        "SELECT userid, count(0) AS cnt FROM click_table GROUP BY userid")


# --------------------------------------------------------------- A1-A10 ---

@query("keyed_max", covers=("A1",), oracle="""
SELECT user_id, arg_min(event_type, event_id) AS event_type, max(ts) AS ts
FROM events GROUP BY user_id
""")
def keyed_max(spark, sf_dir):
    return A.keyed_max(S.events(spark, sf_dir), "user_id", "ts", "event_id", ["event_type"])


@query("running_keyed_max", covers=("A1",), oracle="""
SELECT event_id, user_id,
       first_value(event_type) OVER w AS event_type,
       max(ts) OVER w AS ts
FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def running_keyed_max(spark, sf_dir):
    return A.running_keyed_max(S.events(spark, sf_dir), "user_id", "ts", "event_id",
                               ["event_type"])


@query("reduce_count", covers=("A2", "B4"),
       oracle="SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id")
def reduce_count(spark, sf_dir):
    return A.reduce_count(S.events(spark, sf_dir), "user_id")


@query("running_count", covers=("A2", "K1"), oracle="""
SELECT event_id, user_id,
       count(*) OVER (PARTITION BY user_id ORDER BY event_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt
FROM events
""")
def running_count(spark, sf_dir):
    return A.running_count(S.events(spark, sf_dir), "user_id", "event_id")


@query("most_active_user", covers=("A3", "K1b"), oracle="""
WITH c AS (
  SELECT event_id, user_id,
         count(*) OVER (PARTITION BY user_id ORDER BY event_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt
  FROM events),
l AS (
  SELECT event_id,
         max(cnt * 10000000000 + event_id) OVER (ORDER BY event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lead_key
  FROM c)
SELECT l.event_id, c.user_id AS leader_user_id, c.cnt AS leader_cnt
FROM l JOIN c ON c.event_id = l.lead_key % 10000000000
""")
def most_active_user(spark, sf_dir):
    return A.most_active(S.events(spark, sf_dir), "user_id", "event_id")


@query("reducing_latest", covers=("A6", "G4"), oracle="""
SELECT user_id, arg_min(event_type, event_id) AS event_type, arg_max(ts, event_id) AS ts
FROM events GROUP BY user_id
""")
def reducing_latest(spark, sf_dir):
    return A.reducing_latest(S.events(spark, sf_dir), "user_id", "event_id",
                             ["event_type"], "ts")


@query("map_state_counts", covers=("A8", "G3"), oracle="""
SELECT user_id, event_type, count(*) AS cnt FROM events GROUP BY user_id, event_type
""")
def map_state_counts(spark, sf_dir):
    return A.subkey_counts(S.events(spark, sf_dir), "user_id", "event_type")


@query("count_window_avg", covers=("A9", "A10", "G5"), oracle="""
WITH r AS (
  SELECT user_id, event_id,
         count(*) OVER w AS rn,
         sum((epoch_us(ts) // 1000)) OVER w AS total
  FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT user_id, event_id, rn, CAST(total // rn AS BIGINT) AS avg_ts_ms
FROM r WHERE rn % 10 = 0
""")
def count_window_avg(spark, sf_dir):
    ev = S.events(spark, sf_dir).select("user_id", "event_id", epoch_ms("ts").alias("ts_ms"))
    return A.every_nth_mean(ev, "user_id", "event_id", "ts_ms", 10)


_WORDS_SQL = """
WITH lines AS (
  SELECT unnest(CASE WHEN text = '' THEN []::VARCHAR[]
                     ELSE string_split(CASE WHEN suffix(text, chr(10))
                                            THEN text[1:length(text) - 1] ELSE text END,
                                       chr(10)) END) AS line
  FROM documents),
words AS (
  SELECT unnest(CASE WHEN line <> '' AND rtrim(line, ' ') = '' THEN []::VARCHAR[]
                     ELSE string_split(rtrim(line, ' '), ' ') END) AS word
  FROM lines)
SELECT word, count(*) AS cnt FROM words GROUP BY word
"""


def words(spark, sf_dir):
    docs = S.table(spark, sf_dir, "documents")
    lines = docs.select(F.explode(split_lines("text")).alias("line"))
    return lines.select(F.explode(split_words("line")).alias("word"))


@query("word_count", covers=("A4", "B5", "S2"), oracle=_WORDS_SQL)
def word_count(spark, sf_dir):
    return A.reduce_count(words(spark, sf_dir), "word")


# --------------------------------------------------------------- W1-W9 ---

@query("tumbling_count", covers=("W1", "A13"), oracle=f"""
SELECT time_bucket(INTERVAL '1 hour', ts, {_EPOCH}) AS window_start,
       time_bucket(INTERVAL '1 hour', ts, {_EPOCH}) + INTERVAL '1 hour' AS window_end,
       event_type, count(*) AS cnt
FROM events GROUP BY ALL
""")
def tumbling_count(spark, sf_dir):
    return W.window_count(S.events(spark, sf_dir), "ts", "1 hour", None, ["event_type"])


@query("manual_window", covers=("W9", "G3"), oracle=f"""
SELECT time_bucket(INTERVAL '1 hour', ts, {_EPOCH}) AS window_start,
       time_bucket(INTERVAL '1 hour', ts, {_EPOCH}) + INTERVAL '1 hour' AS window_end,
       event_type, count(*) AS cnt
FROM events GROUP BY ALL
""")
def manual_window(spark, sf_dir):
    return W.manual_window(S.events(spark, sf_dir), "ts", "1 hour", "event_type")


def _sliding_sql(size_h: int, slide_h: int, select: str, group: str) -> str:
    k = size_h // slide_h
    return f"""
WITH w AS (
  SELECT e.*, time_bucket(INTERVAL '{slide_h} hours', ts, {_EPOCH})
              - to_hours(CAST(r.k * {slide_h} AS BIGINT)) AS window_start
  FROM events e CROSS JOIN range(0, {k}) r(k))
SELECT window_start, window_start + INTERVAL '{size_h} hours' AS window_end, {select}
FROM w GROUP BY window_start{group}
"""


@query("sliding_pv_per_uv", covers=("W2", "A11"), oracle=_sliding_sql(
    10, 2, "CAST(count(*) AS DOUBLE) / count(DISTINCT user_id) AS pv_per_uv", ""))
def sliding_pv_per_uv(spark, sf_dir):
    return W.window_pv_per_uv(S.events(spark, sf_dir), "ts", "10 hours", "2 hours", "user_id")


@query("tumbling_uv", covers=("W3", "W4", "A12", "F7"), oracle=f"""
SELECT time_bucket(INTERVAL '10 hours', ts, {_EPOCH}) AS window_start,
       time_bucket(INTERVAL '10 hours', ts, {_EPOCH}) + INTERVAL '10 hours' AS window_end,
       count(DISTINCT user_id) AS uv
FROM events GROUP BY ALL
""")
def tumbling_uv(spark, sf_dir):
    return W.window_uv(S.events(spark, sf_dir), "ts", "10 hours", "user_id")


@query("sliding_count", covers=("W5", "A13"), oracle=_sliding_sql(
    10, 5, "event_type, count(*) AS cnt", ", event_type"))
def sliding_count(spark, sf_dir):
    return W.window_count(S.events(spark, sf_dir), "ts", "10 hours", "5 hours", ["event_type"])


@query("sliding_topn", covers=("W6", "A14", "F8"), headline=True, oracle=f"""
WITH c AS ({_sliding_sql(10, 5, "event_type, count(*) AS cnt", ", event_type")}),
r AS (SELECT *, row_number() OVER (PARTITION BY window_start, window_end
                                  ORDER BY cnt DESC, event_type) AS rank FROM c)
SELECT window_start, window_end, event_type, cnt, rank FROM r WHERE rank <= 2
""")
def sliding_topn(spark, sf_dir):
    return W.sliding_top_n(S.events(spark, sf_dir), "ts", "10 hours", "5 hours", "event_type", 2)


@query("window_sequence", covers=("W8", "F7"), oracle=f"""
WITH c AS (
  SELECT user_id, time_bucket(INTERVAL '3 hours', ts, {_EPOCH}) AS window_start, count(*) AS cnt
  FROM events GROUP BY ALL)
SELECT user_id, window_start, window_start + INTERVAL '3 hours' AS window_end, cnt,
       row_number() OVER (PARTITION BY user_id ORDER BY window_start) AS window_no
FROM c
""")
def window_sequence(spark, sf_dir):
    return W.window_sequence(S.events(spark, sf_dir), "ts", "3 hours", "user_id")


@query("labelled_count", covers=("A7",), oracle="""
SELECT event_id, user_id, 'count：' || count(*) OVER (PARTITION BY user_id ORDER BY event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS label
FROM events
""")
def labelled_count(spark, sf_dir):
    return A.labelled_count(S.events(spark, sf_dir), "user_id", "event_id").select("event_id", "user_id", "label")
