import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ebbflow.session import build_session
    s = build_session("ebbflow-tests", master="local[4]", shuffle_partitions=4,
                      extra={"spark.sql.execution.arrow.maxRecordsPerBatch": "64"})
    yield s
    s.stop()


def rows(df, *cols):
    """Collect as sorted tuples of the given columns (all if none)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
