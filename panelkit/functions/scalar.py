"""Row-level column expressions: flags, bins, tiers, labels, lookups.

All are built-in Spark expressions (JVM side, whole-stage codegen); no
Python runs per row.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelkit import constants as K

_OPS = {
    ">": lambda c, t: c > t,
    "<": lambda c, t: c < t,
    ">=": lambda c, t: c >= t,
    "<=": lambda c, t: c <= t,
    "==": lambda c, t: c == t,
}


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def compare(c: str | Column, op: str, threshold: float) -> Column:
    return _OPS[op](col_(c), F.lit(threshold))


def flag(c: str | Column, op: str, threshold: float) -> Column:
    """0/1 indicator; a missing value gives 0 (a cast of null would not)."""
    return F.when(compare(c, op, threshold), F.lit(1)).otherwise(F.lit(0))


def alarm_flags() -> list[Column]:
    """The six alarm flags."""
    return [flag(src, op, t).alias(name) for name, src, op, t in K.ALARM_FLAGS]


def qsofa(parts: list[str] = K.QSOFA_PARTS) -> Column:
    """Partial qSOFA, the sum of its flag columns."""
    out = F.lit(0)
    for p in parts:
        out = out + F.col(p)
    return out


def bucketize(c: str | Column, rules: list[tuple[str, float, str]],
              default: str | None) -> Column:
    """First matching (op, threshold, label) rule, else default."""
    out = None
    for op, t, label in rules:
        cond = compare(c, op, t)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default)) if default is not None else out


def event_bins() -> list[Column]:
    return [bucketize(src, rules, default).alias(name)
            for name, (src, rules, default) in K.EVENT_BINS.items()]


def tier(c: str | Column, tiers: list[tuple[float, str]], default: str) -> Column:
    """Descending thresholds (value >= t gives label)."""
    return bucketize(c, [(">=", t, label) for t, label in tiers], default)


def probability_tier(prob: str | Column) -> Column:
    return tier(prob, K.PROB_TIERS, K.LOW_TIER)


def vote_tier(positives: str | Column) -> Column:
    return tier(positives, K.VOTE_TIERS, K.LOW_TIER)


def lookup(c: str | Column, mapping: dict, default=None) -> Column:
    """Literal map lookup with a default (``create_map`` + ``coalesce``)."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    v = m[col_(c)]
    return F.coalesce(v, F.lit(default)) if default is not None else v


def api_action(level: str | Column) -> Column:
    return lookup(level, K.API_ACTIONS, K.DEFAULT_ACTION)


def alert_list() -> Column:
    """Names of active flags in served order, then 'High qSOFA' if >= 2."""
    parts = [F.when(F.col(f) > 0, F.lit(text)) for f, text in K.ALERTS]
    parts.append(F.when(F.col("qsofa") >= 2, F.lit(K.QSOFA_ALERT)))
    return F.array_compact(F.array(*parts))


def trend_label(pred: str | Column, current: str | Column,
                margin: float = K.TREND_MARGIN) -> Column:
    """Rising / falling / stable around the current value."""
    p, c = col_(pred), col_(current)
    return (F.when(p > c + margin, F.lit("rising"))
            .when(p < c - margin, F.lit("falling"))
            .otherwise(F.lit("stable")))


def hr_status(pred: str | Column) -> Column:
    """E9."""
    p = col_(pred)
    out = None
    for t, label in K.HR_STATUS:
        out = F.when(p > t, F.lit(label)) if out is None else out.when(p > t, F.lit(label))
    return out.otherwise(F.lit(K.HR_STATUS_DEFAULT))


def zone(pc1: str | Column, pc2: str | Column) -> Column:
    """RED if either coordinate > 1.5, YELLOW if > 0.5, else GREEN."""
    a, b = col_(pc1), col_(pc2)
    out = None
    for t, label in K.ZONES:
        cond = (a > t) | (b > t)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(K.ZONE_DEFAULT))


def similarity_pct(distance: str | Column) -> Column:
    """1 / (1 + distance) * 100, one decimal (half-even like the source)."""
    return F.bround(F.lit(1.0) / (F.lit(1.0) + col_(distance)) * F.lit(100.0), 1)


def outcome_label(label: str | Column) -> Column:
    """E14."""
    return F.when(col_(label) == 1, F.lit(K.OUTCOME_POSITIVE)).otherwise(F.lit(K.OUTCOME_NEGATIVE))


def safe_div(num: str | Column, den: str | Column, default: float = 0.0) -> Column:
    """Division that yields ``default`` on a zero/null denominator (ANSI-safe)."""
    n, d = col_(num), col_(den)
    return F.when(d.isNull() | (d == 0), F.lit(default)).otherwise(n / d)


def round6(c: str | Column) -> Column:
    return F.round(col_(c), 6)
