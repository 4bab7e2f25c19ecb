"""ebbflow: event analytics on Spark DataFrames, Spark SQL and Structured Streaming.

The package holds no execution engine of its own. Every operator is a
function from DataFrame(s) to a DataFrame, so the same code serves batch
tables and (where Spark allows) streaming DataFrames.
"""

from ebbflow.session import build_session, work_dir

__all__ = ["build_session", "work_dir"]
