"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings this library relies on. UTC keeps event times comparable
# across machines; adaptive execution sizes shuffles and splits skewed joins.
# The JVM does not compile methods above 8000 bytes of bytecode, so generated
# code beyond that would be interpreted; such stages use per-operator code instead.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

CHECKPOINT_KEY = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a session without
    that setting (a local test run) gets a temporary folder, set once.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="aerolith-")
        spark.conf.set(CHECKPOINT_KEY, configured)
    return configured.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
