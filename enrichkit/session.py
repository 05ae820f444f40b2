"""Session helpers: shared scratch space and the settings the jobs rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that the operators assume; a cluster's own defaults normally already hold them.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's ``spark.checkpoint.dir``.

    Only when the session names none (as in local tests) a private folder is created
    and registered as the checkpoint directory, so ``DataFrame.checkpoint`` works too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if sc is None or not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="enrichkit-")
        if sc is not None:
            sc.setCheckpointDir(root)
    return root.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext of a classic session (None for a remote session)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make sure ``DataFrame.checkpoint()`` has a reliable directory to write to."""
    sc = _context(spark)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(scratch_root(spark) + "/rdd")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path under the shared scratch folder."""
    return f"{scratch_root(spark)}/enrichkit/{name}-{uuid.uuid4().hex}"


def build_local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the local bench (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("enrichkit")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark
