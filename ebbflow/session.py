"""Session construction and the shared scratch location.

Scratch data (staged CSV copies, sink tables, streaming checkpoints) always
lives under the folder named by ``spark.checkpoint.dir``: on a cluster that
is a shared filesystem every executor can reach. Without the setting a local
master gets a fresh temp folder; any other master is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "ebbflow", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings every job here assumes."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Settings a query needs whatever session it is handed (all runtime SQL confs).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` to a session built elsewhere, make sure the
    shared checkpoint folder is known and ship this package to the executors."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """``addPyFile`` a zip of ``ebbflow`` once per application, so Python
    workers (``mapInPandas``, ``transformWithState``) can import it wherever
    they run, whatever the driver's working directory. The zip is built in
    memory and written to the shared checkpoint folder through Hadoop's
    FileSystem."""
    import io
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    zpath = work_dir(spark, "pyfiles") + "/ebbflow.zip"
    jpath = sc._jvm.org.apache.hadoop.fs.Path(zpath)
    out = jpath.getFileSystem(sc._jsc.hadoopConfiguration()).create(jpath, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(zpath)
    # Streaming Python runners (transformWithState) start before the shipped
    # files are on their path; name the package root in the worker
    # environment as well (a no-op where the folder does not exist).
    paths = [p for p in (sc.environment.get("PYTHONPATH"), root) if p]
    sc.environment["PYTHONPATH"] = os.pathsep.join(dict.fromkeys(paths))
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="ebbflow-ckpt-")  # one machine only, as in tests
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def work_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh folder below the shared checkpoint dir for staged data and
    sinks, made through Hadoop's FileSystem whatever store it is in."""
    sc = spark.sparkContext
    leaf = list(parts) + ([uuid.uuid4().hex[:12]] if unique else [])
    path = "/".join([ensure_checkpoint_dir(spark).rstrip("/"), "ebbflow-work", *leaf])
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(sc._jsc.hadoopConfiguration()).mkdirs(jpath)
    return path


def checkpointed(df):
    """Reliable checkpoint into ``spark.checkpoint.dir`` (never a local one).

    Writing a checkpoint computes the plan a second time unless it is cached,
    so the plan is persisted for the duration of the write: one computation,
    one write, and the lineage is cut.
    """
    from pyspark import StorageLevel
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()
