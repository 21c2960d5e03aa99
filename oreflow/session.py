"""Session defaults and the shared folder that written intermediates live in."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# One scratch root per local application; never used on a cluster.
_local_roots: dict[str, str] = {}


def build_session(app: str = "oreflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for: UTC and adaptive execution."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It is the one named by ``spark.checkpoint.dir``. Only a local-mode session without that setting gets a
    temporary folder, because there driver and executors are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; name a folder that all executors share")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="oreflow-")
    return _local_roots[app]


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has written to."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
