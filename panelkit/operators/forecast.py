"""Window forecasters (J11, J14, J15) as column expressions over lag columns.

Deterministic forecasters are plain expressions (no fit, no Python); the
fitted forecasters live in ``models``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit import constants as K


def lag_names(size: int = K.WINDOW_SIZE) -> list[str]:
    """Oldest first: lag{size} .. lag1."""
    return [f"lag{i}" for i in range(size, 0, -1)]


def smoothing_weights(alpha: float = K.SMOOTHING_ALPHA, size: int = K.WINDOW_SIZE) -> list[float]:
    """J11(b): weights (1-alpha)^(size-1) .. (1-alpha)^0, oldest first, normalised."""
    raw = [(1.0 - alpha) ** i for i in range(size - 1, -1, -1)]
    s = sum(raw)
    return [w / s for w in raw]


def smoothing_forecast(lags: list[Column] | list[str], alpha: float = K.SMOOTHING_ALPHA) -> Column:
    """J11(b): fixed-weight exponential smoothing = dot(window, weights)."""
    cols = [F.col(c) if isinstance(c, str) else c for c in lags]
    ws = smoothing_weights(alpha, len(cols))
    out = F.lit(0.0)
    for c, w in zip(cols, ws):
        out = out + c * F.lit(w)
    return out


def recursive_forecast(df: DataFrame, lags: list[str], steps: int = K.WINDOW_SIZE,
                       alpha: float = K.SMOOTHING_ALPHA, prefix: str = "f") -> DataFrame:
    """Multi-step forecast, each prediction feeding the next window.

    Pure column algebra: step i's window is the last ``len(lags)`` values of
    (lags ++ predictions so far). Unrounded predictions are fed forward.
    """
    window = [F.col(c) for c in lags]
    preds = []
    for i in range(steps):
        p = smoothing_forecast(window[-len(lags):], alpha)
        preds.append(p.alias(f"{prefix}{i + 1}"))
        window = window + [p]
    return df.select("*", *preds)


def linear_extrapolation(lags: list[str], steps: int = K.WINDOW_SIZE) -> list[Column]:
    """Last + (last - first) / (size - 1) * (i + 1), one decimal (half-even).

    The expression is only meaningful for complete windows; rows with a null
    lag yield null forecasts (the reject condition)."""
    first, last = F.col(lags[0]), F.col(lags[-1])
    slope = (last - first) / float(len(lags) - 1)
    return [F.bround(last + slope * float(i + 1), 1).alias(f"x{i + 1}") for i in range(steps)]


def forecast_alerts(step_cols: list[str], threshold: float = K.FORECAST_ALERT_HR) -> list[Column]:
    """Per-step alert flags, danger count and the served message."""
    arr = F.array(*[F.col(c) for c in step_cols])
    danger = F.size(F.filter(arr, lambda v: v > F.lit(threshold)))
    msg = F.when(danger > 0, F.format_string(
        "HR predicted >100bpm in %d of next 6 hours", danger)).otherwise(F.lit("No danger predicted"))
    flags = F.concat_ws(",", F.transform(arr, lambda v: F.when(v > F.lit(threshold), F.lit("1")).otherwise(F.lit("0"))))
    return [flags.alias("step_alerts"), danger.alias("danger_hours"), (danger > 0).alias("alert"),
            msg.alias("alert_message")]


def recursive_model_forecast(model, df: DataFrame, lags: list[str], steps: int = K.WINDOW_SIZE,
                             with_summary: bool = True, features: str = "features",
                             prefix: str = "f") -> DataFrame:
    """J14 for a fitted model: ``steps`` scoring passes, each appending its
    prediction to the window that feeds the next pass.

    Every pass is a projection + ``model.transform`` over the same rows (no
    shuffle); the input should be cached by the caller when it is expensive.
    ``with_summary`` adds mean / population std / last-first of the window
    as the model's extra inputs, in that order after the lags.

    Boosted trees are scored in blocks of rows, all passes of a block in one
    go (``tree_scoring``): node by node, the passes cost more than the fit.
    """
    from pyspark.ml.feature import VectorAssembler

    from panelkit.operators import tree_scoring
    from panelkit.operators.windows import window_summary
    predict = tree_scoring.predictor(model, len(lags) + 3 * with_summary)
    if predict is not None:
        return _recursive_tree_passes(predict, df, lags, steps, with_summary, prefix)
    cur = df
    window = list(lags)
    for i in range(steps):
        inputs = [F.col(c) for c in window[-len(lags):]]
        named = [c.alias(f"_w{j}") for j, c in enumerate(inputs)]
        staged = cur.select("*", *named)
        wcols = [f"_w{j}" for j in range(len(lags))]
        if with_summary:
            staged = staged.select("*", *window_summary(wcols))
            wcols = wcols + ["w_mean", "w_std", "w_trend"]
        vec = VectorAssembler(inputCols=wcols, outputCol=features).transform(staged)
        out = model.transform(vec).withColumnRenamed("prediction", f"{prefix}{i + 1}")
        drop = [c for c in out.columns if c.startswith("_w") or c in ("w_mean", "w_std", "w_trend", features)]
        cur = out.drop(*drop)
        window.append(f"{prefix}{i + 1}")
    return cur


def _recursive_tree_passes(predict, df: DataFrame, lags: list[str], steps: int, with_summary: bool,
                           prefix: str) -> DataFrame:
    """The passes of ``recursive_model_forecast`` over Arrow batches."""
    from pyspark.sql import types as T

    names = [f"{prefix}{i + 1}" for i in range(steps)]
    size, at = len(lags), [df.columns.index(c) for c in lags]
    schema = T.StructType([*df.schema.fields, *[T.StructField(c, T.DoubleType()) for c in names]])

    def passes(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            window = [batch.column(i).cast(pa.float64()).to_numpy(zero_copy_only=False) for i in at]
            for _ in names:
                inputs = window[-size:]
                if with_summary:  # as windows.window_summary, term by term
                    mean = sum(inputs, np.zeros(len(batch))) / float(size)
                    var = sum(((c - mean) * (c - mean) for c in inputs), np.zeros(len(batch))) / float(size)
                    inputs = [*inputs, mean, np.sqrt(var), inputs[-1] - inputs[0]]
                if any(np.isnan(c).any() for c in inputs):  # as VectorAssembler
                    raise ValueError("recursive_model_forecast: a window has a null or NaN value")
                window.append(predict(inputs))
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, window[size:])],
                                             names=[*batch.schema.names, *names])

    return df.mapInArrow(passes, schema)
