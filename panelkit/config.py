"""Session helpers: a local session for tests/bench and shared-folder lookup."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Largest row count we ever broadcast. Every broadcast in this package is of
# a table bounded by construction (class counts, centres, thresholds, one row
# per range partition) or is size-checked against this bound first.
BROADCAST_ROW_LIMIT = 1_000_000


def local_session(cores: str = "*", shuffle_partitions: int = 8,
                  app: str = "panelkit") -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="panelkit-wh-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage; we only read it.
    When it is unset (local tests) a private folder is created and set.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getCheckpointDir()
    if not conf_dir and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not conf_dir:
        conf_dir = tempfile.mkdtemp(prefix="panelkit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared folder for tables written by a job."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (survives executor loss)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ensure_bounded(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT,
                   what: str = "table") -> DataFrame:
    """Raise unless ``df`` has at most ``limit`` rows (checked with a capped count)."""
    n = df.limit(limit + 1).count()
    if n > limit:
        raise ValueError(f"{what} has more than {limit} rows; refusing to broadcast it")
    return df
