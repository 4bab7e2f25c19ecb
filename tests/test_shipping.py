"""Python workers import the package whatever the driver's working directory."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as E
from ebbflow.session import build_session
spark = build_session(master="local[2]", shuffle_partitions=2)
# state_machine runs mapInPandas with functions defined in the package
print("ROWS", E.queries()["state_machine"](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_import_package_from_another_cwd():
    cwd = tempfile.mkdtemp(prefix="ebbflow-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env,
                         capture_output=True, text=True, timeout=600)
    assert "ROWS " in res.stdout, res.stderr[-3000:]
    assert int(res.stdout.split("ROWS ")[1].split()[0]) > 0
