"""Registry of named queries: a Spark plan and (when SQL can state it) an oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DoubleType, FloatType, IntegerType,
                               LongType, ShortType)

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    ops: str  # SURVEY operator ids covered


REGISTRY: dict[str, Query] = {}


# Output rounding for the oracle comparison, identical in both engines:
# half away from zero at 6 decimals after a 1e-9 push away from zero. Exact
# decimal ties (common: means of few-decimal values) otherwise fall on
# either side by float summation noise (~1e-13), which differs by engine.
GUARD = 1e-9


def _skip_string(sql: str, k: int) -> int:
    """Index just past the SQL string literal starting at ``k`` ('' escapes)."""
    k += 1
    while True:
        k = sql.index("'", k)
        if k + 1 < len(sql) and sql[k + 1] == "'":
            k += 2
            continue
        return k + 1


def guard_round_sql(sql: str, digits: int = 6) -> str:
    """Rewrite every ``round(expr, 6)`` (outside string literals) into the
    guarded form ``round((expr) + sign(expr) * GUARD, 6)``."""
    out, i, n = [], 0, len(sql)
    token = "round("
    while i < n:
        ch = sql[i]
        if ch == "'":
            k = _skip_string(sql, i)
            out.append(sql[i:k])
            i = k
            continue
        starts = sql[i:i + len(token)].lower() == token
        ident_before = i > 0 and (sql[i - 1].isalnum() or sql[i - 1] == "_")
        if not starts or ident_before:
            out.append(ch)
            i += 1
            continue
        depth, k, last_comma = 1, i + len(token), None
        while depth:
            c = sql[k]
            if c == "'":
                k = _skip_string(sql, k)
                continue
            if c == "(":
                depth += 1
            elif c == ")":
                depth -= 1
            elif c == "," and depth == 1:
                last_comma = k
            k += 1
        body_start = i + len(token)
        if last_comma is not None and sql[last_comma + 1:k - 1].strip() == str(digits):
            expr = guard_round_sql(sql[body_start:last_comma], digits)
            out.append(f"round(({expr}) + sign({expr}) * {GUARD}, {digits})")
        else:
            out.append(token + guard_round_sql(sql[body_start:k - 1], digits) + ")")
        i = k
    return "".join(out)


def query(name: str, ops: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, guard_round_sql(sql) if sql else None, ops)
        return fn
    return deco


def finish(df: DataFrame) -> DataFrame:
    """Oracle-comparable output: floats rounded (guarded) to 6 digits, integers as BIGINT."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            d = c.cast("double")
            cols.append(F.round(d + F.signum(d) * F.lit(GUARD), 6).alias(f.name))
        elif isinstance(f.dataType, (ByteType, ShortType, IntegerType, LongType)):
            cols.append(c.cast("bigint").alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)
