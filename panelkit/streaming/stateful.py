"""Structured Streaming forms of the panel operators (ST1-ST4).

ST1 stateless scoring reuses the batch column expressions on a stream.
ST2 keeps, per entity, only what the next rows need: the forward-fill
carry of each vital, the last ``HISTORY`` imputed values of the rolling
columns, the row count (the ordinal) and the last (ts, id) processed. A
micro-batch's rows arrive unsorted, so the state function sorts them;
rows at or before the last processed (ts, id) are late: dropped and
counted. Idle entities expire through an event-time timeout under the
watermark. Backward fill needs the future and is not offered on streams.
ST3 adds the six-step linear extrapolation once six values exist. ST4
appends alert rows to the prediction log through a checkpointed file sink
(exactly once across restarts).
"""

from __future__ import annotations

from decimal import ROUND_HALF_EVEN, Decimal
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

import panelkit
from panelkit import constants as K
from panelkit.config import scratch_path
from panelkit.functions import scalar as X
from panelkit.operators import aggregate as agg

VITALS = K.VITALS_LC
FILL_FORWARD = VITALS + ["lactate"]
HISTORY = K.WINDOW_SIZE - 1           # rows of history a 6-row frame needs
ROLLED = ["hr", "sbp", "map", "resp", "temp"]

STATE_SCHEMA = ("n long, last_ts long, last_id long, late long, carry array<double>, "
                + ", ".join(f"h_{c} array<double>" for c in ROLLED))

OUT_COLS = (["patient_id", "iculos"] + FILL_FORWARD + ["age", "gender", "sepsislabel"]
            + [c for c, _, _ in K.ROLLING_MEANS] + [c for c, _ in K.TRENDS]
            + [c for c, _, _ in K.ROLLING_STDS] + K.FLAG_COLS + ["qsofa", "hours_in_icu"]
            + [f"fc{i}" for i in range(1, 7)])
_INTS = {"iculos", "sepsislabel", "qsofa", "hours_in_icu", *K.FLAG_COLS}
OUTPUT_SCHEMA = ", ".join(
    f"{c} string" if c == "patient_id" else (f"{c} int" if c in _INTS else f"{c} double") for c in OUT_COLS)

_CMP = {">": np.greater, "<": np.less}

# The state function runs in Python workers, which may not have this package
# on their path (cluster executors, another working directory): ship the
# package's code inside the pickled function instead of by module reference.
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(panelkit)
except (ImportError, ValueError):  # pragma: no cover - older cloudpickle
    pass


def event_rows(events: DataFrame) -> DataFrame:
    """Row-level part of the panel definition plus an event-time column."""
    from panelkit.sources.tables import event_vitals
    return event_vitals(events).withColumn("event_time", F.col("ts").cast("timestamp"))


def _bround1(x: float) -> float:
    """Half-even on the shortest decimal form (the same rule as Spark's bround)."""
    if x is None or not np.isfinite(x):
        return np.nan
    return float(Decimal(repr(float(x))).quantize(Decimal("0.1"), rounding=ROUND_HALF_EVEN))


def _bround1_vec(x: np.ndarray) -> np.ndarray:
    """``_bround1`` over an array: away from a decimal half every rounding rule
    agrees, so only values within 1e-7 of one take the exact Decimal path."""
    out = np.round(x, 1)
    with np.errstate(invalid="ignore"):
        frac = np.abs(np.mod(x * 10.0, 1.0) - 0.5)
    near = np.isfinite(x) & (frac < 1e-7)
    if near.any():
        out[near] = [_bround1(v) for v in x[near]]
    return out


def _ffill(values: np.ndarray, carry: float | None) -> np.ndarray:
    v = np.concatenate([[np.nan if carry is None else carry], values])
    last = np.maximum.accumulate(np.where(np.isnan(v), 0, np.arange(len(v))))
    return v[last][1:]


def _frames(x: np.ndarray, w: int) -> np.ndarray:
    """One row a value: it and the ``w - 1`` values before it; missing and non-finite as NaN."""
    x = np.concatenate([np.full(w - 1, np.nan), np.where(np.isfinite(x), x, np.nan)])
    return np.lib.stride_tricks.sliding_window_view(x, w)


def _rolling_mean(x: np.ndarray, w: int) -> np.ndarray:
    """Mean of the values in the frame, NaN without any."""
    f = _frames(x, w)
    known = ~np.isnan(f)
    n = known.sum(axis=1)
    return np.where(n > 0, np.where(known, f, 0.0).sum(axis=1) / np.maximum(n, 1), np.nan)


def _rolling_std(x: np.ndarray, w: int) -> np.ndarray:
    """Sample standard deviation of the values in the frame, 0 for fewer than two."""
    f = _frames(x, w)
    known = ~np.isnan(f)
    n = known.sum(axis=1)
    mean = np.where(known, f, 0.0).sum(axis=1) / np.maximum(n, 1)
    off = np.where(known, f - mean[:, None], 0.0)
    return np.where(n > 1, np.sqrt((off * off).sum(axis=1) / np.maximum(n - 1, 1)), 0.0)


def rolling_step(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """ST2/ST3 state function: one entity, one micro-batch."""
    if state.hasTimedOut:
        state.remove()
        return
    parts = list(pdfs)
    pdf = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
    if pdf.empty:
        return
    ts, ids = pd.to_datetime(pdf["ts"]).astype("int64").to_numpy(), pdf["event_id"].to_numpy()
    order = np.lexsort((ids, ts))
    ts, ids = ts[order], ids[order]
    if state.exists:
        n, last_ts, last_id, late, carry, *hist = state.get
        carry = list(carry)
        hist = {c: list(h) for c, h in zip(ROLLED, hist)}
    else:
        n, last_ts, last_id, late = 0, None, None, 0
        carry = [None] * len(FILL_FORWARD)
        hist = {c: [] for c in ROLLED}
    if last_ts is not None:
        fresh = (ts > last_ts) | ((ts == last_ts) & (ids > last_id))
        late += int((~fresh).sum())
        order, ts, ids = order[fresh], ts[fresh], ids[fresh]
    m = len(order)
    if m == 0:
        state.update((n, last_ts, last_id, late, carry, *[hist[c] for c in ROLLED]))
        return
    out = {"patient_id": pdf["patient_id"].to_numpy()[order], "iculos": np.arange(n + 1, n + m + 1, dtype="int32")}
    for i, c in enumerate(FILL_FORWARD):
        filled = _ffill(pdf[c].to_numpy(dtype="float64")[order], carry[i])
        out[c] = filled
        last = filled[-1]
        carry[i] = None if np.isnan(last) else float(last)
    for c in ["age", "gender"]:
        out[c] = pdf[c].to_numpy(dtype="float64")[order]
    out["sepsislabel"] = pdf["sepsislabel"].to_numpy(dtype="int32")[order]
    ext = {}
    for c in ROLLED:
        past = np.array([np.nan if v is None else v for v in hist[c]], dtype="float64")
        ext[c] = np.concatenate([past, out[c]])
    h = {c: len(hist[c]) for c in ROLLED}
    for name, src, w in K.ROLLING_MEANS:
        out[name] = _rolling_mean(ext[src], w)[h[src]:]
    for name, src in K.TRENDS:
        out[name] = np.diff(ext[src], prepend=np.nan)[h[src]:]
    for name, src, w in K.ROLLING_STDS:
        out[name] = _rolling_std(ext[src], w)[h[src]:]
    for name, src, op, t in K.ALARM_FLAGS:
        vals = out[src]
        with np.errstate(invalid="ignore"):
            out[name] = np.where(np.isnan(vals), False, _CMP[op](vals, t)).astype("int32")
    out["qsofa"] = (out["flag_tachypnea"] + out["flag_low_bp"]).astype("int32")
    out["hours_in_icu"] = out["iculos"]
    # ST3: six-step linear extrapolation from the last six hr values (first and last used)
    first = np.concatenate([np.full(K.WINDOW_SIZE - 1, np.nan), ext["hr"]])[:len(ext["hr"])][h["hr"]:]
    lastv = out["hr"]
    enough = (n + np.arange(1, m + 1)) >= K.WINDOW_SIZE
    slope = (lastv - first) / float(K.WINDOW_SIZE - 1)
    ahead = np.stack([np.where(enough, lastv + slope * float(i), np.nan) for i in range(1, 7)])
    for i, steps in enumerate(_bround1_vec(ahead.ravel()).reshape(ahead.shape), 1):
        out[f"fc{i}"] = steps
    for c in OUT_COLS:
        if c != "patient_id" and not c.startswith("fc") and out[c].dtype.kind == "f":
            out[c] = np.nan_to_num(out[c], nan=0.0)
    for c in ROLLED:
        hist[c] = [None if np.isnan(v) else float(v) for v in ext[c][-HISTORY:]]
    n += m
    last_ts, last_id = int(ts[-1]), int(ids[-1])
    state.update((n, last_ts, last_id, late, carry, *[hist[c] for c in ROLLED]))
    if state.getCurrentWatermarkMs() > 0:
        state.setTimeoutTimestamp(state.getCurrentWatermarkMs() + 6 * 3600 * 1000)
    yield pd.DataFrame({c: out[c] for c in OUT_COLS})


def rolling_features_stream(rows: DataFrame, watermark: str = "6 hours") -> DataFrame:
    """ST2 + ST3 on a stream of event rows (``event_rows`` output)."""
    return (rows.withWatermark("event_time", watermark)
            .groupBy("patient_id")
            .applyInPandasWithState(rolling_step, OUTPUT_SCHEMA, STATE_SCHEMA, "append",
                                    "EventTimeTimeout"))


def score_stream(features: DataFrame) -> DataFrame:
    """ST1 + ST3: stateless scoring with the batch expressions, plus the
    forecast alert once an entity has six values (E12 on fc1..fc6)."""
    from panelkit.operators.forecast import forecast_alerts
    score = agg.risk_score()
    steps = [f"fc{i}" for i in range(1, 7)]
    alerts = forecast_alerts(steps)
    return features.select("patient_id", "iculos", "hr", "temp", score.alias("score"),
                           X.probability_tier(score).alias("risk_level"),
                           F.concat_ws(", ", X.alert_list()).alias("alerts"),
                           alerts[1], alerts[3].alias("forecast_message"))


def assess_stream(spark: SparkSession, features: DataFrame, model_path: str, out: str | None = None,
                  checkpoint: str | None = None) -> DataFrame:
    """ST1: a stream of feature rows through the saved scoring pipeline
    (``scoring.load``), the same one that scores batches; run to completion
    into a checkpointed file sink and read back."""
    from panelkit.operators import scoring
    path = run_to_table(scoring.load(model_path).transform(features), spark, "assessments", out=out,
                        checkpoint=checkpoint)
    return spark.read.parquet(path)


def table_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New files of a parquet table as a stream."""
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def alert_log_rows(scored: DataFrame) -> DataFrame:
    """ST4 rows in the prediction-log schema; only non-low tiers are logged."""
    rid = F.xxhash64("patient_id", "iculos")
    return (scored.filter(F.col("risk_level") != K.LOW_TIER)
            .select(rid.alias("id"), F.col("patient_id").alias("patient_name"),
                    F.col("hr").alias("heart_rate"), F.col("temp"),
                    F.col("risk_level").alias("sepsis_risk")))


def events_stream(spark: SparkSession, path_glob: str, max_files: int | None = None) -> DataFrame:
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path_glob)


def run_to_table(stream: DataFrame, spark: SparkSession, name: str, fmt: str = "parquet",
                 out: str | None = None, checkpoint: str | None = None) -> str:
    """Run a stream to completion (availableNow) into a checkpointed file sink
    under the shared folder; returns the output path."""
    out = out or scratch_path(spark, f"{name}-out")
    ckpt = checkpoint or scratch_path(spark, f"{name}-ckpt")
    q = (stream.writeStream.format(fmt).option("path", out).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def stream_features(spark: SparkSession, events_glob: str, max_files: int | None = None) -> DataFrame:
    """Run ST2/ST3 over the event files and read the result back as a table."""
    rows = event_rows(events_stream(spark, events_glob, max_files))
    path = run_to_table(rolling_features_stream(rows), spark, "stream-features")
    return spark.read.parquet(path)


def stream_scores(spark: SparkSession, events_glob: str) -> DataFrame:
    """ST1 over ST2 output, as a stream, read back as a table."""
    rows = event_rows(events_stream(spark, events_glob))
    path = run_to_table(score_stream(rolling_features_stream(rows)), spark, "stream-scores")
    return spark.read.parquet(path)


def append_alert_log(spark: SparkSession, events_glob: str, log_path: str, checkpoint: str) -> DataFrame:
    """ST4: append alert rows to the log; re-running with the same checkpoint
    processes only new files, so rows are written exactly once."""
    rows = event_rows(events_stream(spark, events_glob))
    logged = alert_log_rows(score_stream(rolling_features_stream(rows)))
    run_to_table(logged, spark, "alert-log", out=log_path, checkpoint=checkpoint)
    return spark.read.parquet(log_path)
