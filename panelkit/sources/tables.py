"""Table scans and the two panels derived from the driver's tables.

The panel is a deterministic function of ``events`` (one entity per user,
one row per event in time order). Its definition is fixed so that Spark and
an independent SQL engine compute the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]

PANEL_COLUMNS = ["patient_id", "iculos", "hr", "o2sat", "temp", "sbp", "map",
                 "dbp", "resp", "lactate", "age", "gender", "sepsislabel"]


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Parquet scan; a column list becomes the scan's ReadSchema."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def table_version(spark: SparkSession, sf_dir: str, name: str) -> tuple | None:
    """(modification time, length) of a table's files via the Hadoop FS, or
    None when it cannot be read (then callers do not cache by version)."""
    try:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        st = fs.getFileStatus(path)
        return (st.getModificationTime(), st.getLen())
    except Exception:  # noqa: BLE001 - no JVM access (e.g. remote session)
        return None


def _mod(c: Column, m: int) -> Column:
    return c % F.lit(m)


def event_vitals(ev: DataFrame) -> DataFrame:
    """Row-level part of the panel definition: one vitals row per event, keyed
    by (patient_id, ts, event_id); everything except the ordinal."""
    k = F.regexp_extract("props", r"([0-9]+)", 1).cast("int")
    ev = ev.withColumn("k", k)
    et, v, eid = F.col("event_type"), F.col("value"), F.col("event_id")
    return ev.select(
        F.concat(F.lit("p"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("patient_id"),
        "ts", "event_id",
        F.when(et != "error", 50 + v / 2).alias("hr"),
        F.when(et != "view", F.greatest(F.lit(60.0), 100 - v / 12)).alias("o2sat"),
        F.when(et != "signup", 35.5 + F.col("k") / 25.0).alias("temp"),
        (85 + _mod(eid * 53, 100) * 7 / 10.0).alias("sbp"),
        F.when(et != "click", 55 + _mod(eid * 37, 100) / 2.0).alias("map"),
        (40 + _mod(eid * 71, 100) / 2.0).alias("dbp"),
        F.when(et != "purchase",
               (10 + _mod(eid * 89 + F.col("k"), 20)).cast("double")).alias("resp"),
        F.when(et == "purchase", 0.5 + v / 40).alias("lactate"),
        (20 + _mod(F.col("user_id"), 70)).cast("double").alias("age"),
        _mod(F.col("user_id"), 2).cast("double").alias("gender"),
        F.when((v > 90) & (F.col("k") > 60), 1).otherwise(0).alias("sepsislabel"),
    )


def panel_rows_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel before its ordinal: vitals rows with (ts, event_id) order keys."""
    ev = read_table(spark, sf_dir, "events",
                    ["event_id", "ts", "user_id", "event_type", "value", "props"])
    return event_vitals(ev)


def panel_from_events(spark: SparkSession, sf_dir: str, chunk_rows: int | None = None) -> DataFrame:
    """Hourly vital-sign panel, grain (patient_id, iculos), from ``events``.

    Five vitals are null on one event type each, ``lactate`` is a sparse lab,
    and the label shares its inputs with hr/temp. ``iculos`` is the row's
    position in its entity by (ts, event_id); an entity too large for one
    task is numbered in time chunks with carried offsets (``skew``).
    """
    from panelkit.operators import skew
    rows = panel_rows_from_events(spark, sf_dir)
    known = False
    if chunk_rows is None:
        from panelkit.plans.q_panel import panel_has_hot
        known = not panel_has_hot(spark, sf_dir)
    numbered, _ = skew.ordinal_and_impute(rows, "patient_id", ["ts", "event_id"], [], [], "iculos",
                                          chunk_rows or skew.DEFAULT_CHUNK_ROWS, known_no_hot=known)
    return numbered.select(*PANEL_COLUMNS)


def panel_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second, long-tailed panel: customers' orders in date order, value = price.

    Dates tie, so the order key is the tie-breaker. Entities have 1..n rows,
    which exercises short entities and minimum-history filters.
    """
    return read_table(spark, sf_dir, "orders",
                      ["o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"])
