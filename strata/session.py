"""Session helpers: sensible defaults for local runs and a checkpoint dir
taken from the cluster configuration when one is set."""

from __future__ import annotations

import os
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # keep-latest and struct aggregates are sort-based; let them join whole-stage codegen
    "spark.sql.codegen.aggregate.sortAggregate.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "strata",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Return a session; on a cluster pass ``master=None`` so spark-submit decides."""
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
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when it is unset on a local master (local runs, tests) a private
    scratch folder is created and registered; on a cluster an unset value is
    an error rather than a silent machine-local fallback."""
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext: use the configuration
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder every executor shares")
        return d
    current = sc.getCheckpointDir()
    if current:
        return current
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder every executor shares "
                               "(a machine-local folder cannot hold checkpoints on a cluster)")
        d = tempfile.mkdtemp(prefix="strata-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    return d


def app_id(spark: SparkSession) -> str:
    """Identifier of the running application (classic and Connect sessions)."""
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location (never machine-local
    on a cluster) for intermediate files a job writes and reads back."""
    import uuid
    return f"{checkpoint_dir(spark).rstrip('/')}/strata-scratch/{name}-{uuid.uuid4().hex[:12]}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CLEANING: dict[str, list] = {}
_CLEANING_LOCK = threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a statement that is run meanwhile are deleted when it ends, not when the driver happens to
    collect its garbage. Writes may run at the same time: the last one restores the session's setting."""
    app = app_id(spark)
    with _CLEANING_LOCK:
        running, old = _CLEANING.get(app, (0, None))
        if not running:
            old = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _CLEANING[app] = [running + 1, old]
    try:
        yield
    finally:
        with _CLEANING_LOCK:
            running, old = _CLEANING.pop(app)
            if running > 1:
                _CLEANING[app] = [running - 1, old]
            elif old is None:
                spark.conf.unset(_CLEANUP)
            else:
                spark.conf.set(_CLEANUP, old)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder whose last reader is done."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
