"""Sinks (A6, A7, A9-A11): tables, bucketed feature tables, metrics, logs.

Every write is one Spark job; overwrite semantics replace the table
atomically at the catalog level, appends go through the file sink's commit
protocol, so a retried task never duplicates rows.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators.panel import PanelSpec

LOG_SCHEMA = "id long, patient_name string, heart_rate double, temp double, sepsis_risk string"


def write_clean(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Write cleaned rows (parquet by default; CSV with header on request)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def replace_table(df: DataFrame, name: str) -> None:
    """Drop-and-reload as one overwrite of a catalog table."""
    df.write.mode("overwrite").saveAsTable(name)


def write_feature_table(df: DataFrame, name: str, spec: PanelSpec, buckets: int = 64) -> None:
    """Replace the feature table, bucketed and sorted by entity.

    Later per-entity jobs (profiles, windows, splits) read it without a
    shuffle on the entity key.
    """
    (df.write.mode("overwrite").bucketBy(buckets, spec.entity)
     .sortBy(spec.entity, *spec.order).saveAsTable(name))


def metrics_frame(spark: SparkSession, task: str, model: str, values: dict[str, float]) -> DataFrame:
    """A10: a long (task, model, metric, value) frame from a few scalars."""
    rows = [(task, model, k, float(v)) for k, v in values.items()]
    return spark.createDataFrame(rows, "task string, model string, metric string, value double")


def write_metrics(df: DataFrame, path: str, fmt: str = "json") -> None:
    """A10: metric documents; small, so one file."""
    df.coalesce(1).write.mode("overwrite").format(fmt).save(path)


def write_json_document(spark: SparkSession, doc: dict, path: str) -> None:
    """A10: a nested document (e.g. a run manifest) as one JSON record."""
    spark.createDataFrame([(json.dumps(doc, sort_keys=True),)], "doc string") \
        .coalesce(1).write.mode("overwrite").text(path)


def save_model(model, path: str) -> None:
    """A10: fitted Spark ML model persistence."""
    model.write().overwrite().save(path)


def append_log(df: DataFrame, path: str) -> None:
    """Append scored rows to the prediction log (schema ``LOG_SCHEMA``)."""
    cols = [c.split()[0] for c in LOG_SCHEMA.split(", ")]
    df.select(*[F.col(c) for c in cols]).write.mode("append").parquet(path)
