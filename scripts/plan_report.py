"""Summarise the physical plan of every batch query (``explain("formatted")``).

Usage: python scripts/plan_report.py [sf_dir] > PLANS.md

Plans are made as large inputs get them: no broadcast by measured size, and
chunks of ROWS_PER_CHUNK rows, so that running values of hot keys are cut.

Per query: shuffles (hash/range exchanges), single-partition exchanges (a
whole input through one task), broadcasts, joins, windows, Python stages, and
whether filters reach the parquet scan. Streaming queries are run, not
planned, so they are skipped here.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ebbflow.session import build_session  # noqa: E402

ROWS_PER_CHUNK = 200
SKIP_PREFIX = ("stream_", "state_ttl", "resume_")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(text: str) -> dict:
    tree = text.split("\n\n")[0]
    return {
        "shuffles": len(re.findall(r"\bExchange \(", tree)),
        "single": len(re.findall(r"SinglePartition", text)),
        "broadcast": len(re.findall(r"BroadcastExchange", tree)),
        "smj": len(re.findall(r"SortMergeJoin", tree)),
        "bhj": len(re.findall(r"BroadcastHashJoin", tree)),
        "window": len(re.findall(r"\bWindow \(", tree)),
        "group_limit": len(re.findall(r"WindowGroupLimit", tree)),
        "python": len(re.findall(r"MapInPandas|FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython",
                                 tree)),
        "pushed": "PushedFilters: [" in text and not re.search(r"PushedFilters: \[\]", text),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("ebbflow-plans", master="local[8]", shuffle_partitions=16)
    from ebbflow.operators.running import ROWS_PER_CHUNK_CONF
    from ebbflow.plans import registry
    spark.conf.set(ROWS_PER_CHUNK_CONF, str(ROWS_PER_CHUNK))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    cols = ["shuffles", "single", "broadcast", "smj", "bhj", "window", "group_limit", "python",
            "pushed"]
    print(f"# Physical plans at {os.path.basename(sf_dir)} (initial AQE plan, no measured broadcasts, chunks of {ROWS_PER_CHUNK} rows)\n")
    print("| query | " + " | ".join(cols) + " |")
    print("| --- |" + " --- |" * len(cols))
    for name, q in sorted(registry().items()):
        if name.startswith(SKIP_PREFIX):
            continue
        s = summarise(plan_text(q.build(spark, sf_dir)))
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
