"""Data-quality gates (Q1-Q9): each check is one aggregate producing a row
(check_name, observed, threshold, passed); the summary is their union plus
an ``all_passed`` row, and ``assert_passed`` turns it into a job exit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from panelkit.operators.panel import PanelSpec

CHECK_SCHEMA = "check_name string, observed double, threshold double, passed boolean"


def _row(df: DataFrame, name: str, observed, threshold: float, passed) -> DataFrame:
    return df.select(F.lit(name).alias("check_name"), observed.cast("double").alias("observed"),
                     F.lit(float(threshold)).alias("threshold"), passed.alias("passed"))


def row_count_gate(df: DataFrame, minimum: int, name: str = "row_count") -> DataFrame:
    """Q1: more than ``minimum`` rows."""
    c = df.agg(F.count(F.lit(1)).alias("n"))
    return _row(c, name, F.col("n"), minimum, F.col("n") > minimum)


def no_nulls(df: DataFrame, columns: list[str], name: str = "no_nulls") -> DataFrame:
    """Q3: no row with a null in any of ``columns``."""
    cond = F.lit(False)
    for col in columns:
        cond = cond | F.col(col).isNull()
    c = df.agg(F.sum(F.when(cond, 1).otherwise(0)).alias("n"))
    n = F.coalesce(F.col("n"), F.lit(0))
    return _row(c, name, n, 0, n == 0)


def both_classes(df: DataFrame, label: str, name: str = "both_classes") -> DataFrame:
    """Q4: exactly two label values present."""
    c = df.agg(F.countDistinct(label).alias("n"))
    return _row(c, name, F.col("n"), 2, F.col("n") == 2)


def in_range(df: DataFrame, column: str, lo: float, hi: float, name: str | None = None) -> DataFrame:
    """Q5: count of values outside [lo, hi] must be 0."""
    out = (F.col(column) < lo) | (F.col(column) > hi)
    c = df.agg(F.sum(F.when(out, 1).otherwise(0)).alias("n"))
    n = F.coalesce(F.col("n"), F.lit(0))
    return _row(c, name or f"{column}_in_range", n, 0, n == 0)


def grain_unique(df: DataFrame, keys: list[str], name: str = "grain_unique") -> DataFrame:
    """Q8: the key columns identify rows (duplicate count is 0).

    Two-level: count per key (partial aggregation), then sum the excess."""
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
    c = per.agg(F.sum(F.col("c") - 1).alias("n"))
    n = F.coalesce(F.col("n"), F.lit(0))
    return _row(c, name, n, 0, n == 0)


def window_identity(windows: DataFrame, panel: DataFrame, spec: PanelSpec, size: int,
                    name: str = "window_identity") -> DataFrame:
    """Q8: windows = sum(n - size) over entities with n > size."""
    per = panel.groupBy(spec.entity).agg(F.count(F.lit(1)).alias("n"))
    expected = per.agg(F.sum(F.when(F.col("n") > size, F.col("n") - size).otherwise(0)).alias("e"))
    got = windows.agg(F.count(F.lit(1)).alias("g"))
    both = expected.unionByName(got.select(F.negative(F.col("g")).alias("e")))
    d = both.agg(F.sum("e").alias("d"))
    diff = -F.coalesce(F.col("d"), F.lit(0))
    return _row(d, name, diff, 0, diff == 0)


def next_row_identity(next_rows: DataFrame, panel: DataFrame, spec: PanelSpec,
                      name: str = "next_row_identity") -> DataFrame:
    """Q8: rows with a next-row target = rows - entities."""
    a = panel.agg((F.count(F.lit(1)) - F.countDistinct(spec.entity)).alias("e"))
    b = next_rows.agg(F.negative(F.count(F.lit(1))).alias("e"))
    d = a.unionByName(b).agg(F.sum("e").alias("d"))
    diff = -F.col("d")
    return _row(d, name, diff, 0, diff == 0)


def metric_floors(metrics: DataFrame, floors: list[tuple[str, float, str]]) -> DataFrame:
    """Q7: join a (metric, value) table with (metric, bound, min|max) floors."""
    spark = metrics.sparkSession
    t = spark.createDataFrame(floors, "metric string, bound double, kind string")
    j = metrics.join(F.broadcast(t), on="metric", how="inner")
    passed = F.when(F.col("kind") == "min", F.col("value") > F.col("bound")).otherwise(F.col("value") < F.col("bound"))
    return j.select("metric", "value", "bound", passed.alias("passed"))


def _check(name: str, observed, threshold: float, passed):
    return F.struct(F.lit(name).alias("check_name"), observed.cast("double").alias("observed"),
                    F.lit(float(threshold)).alias("threshold"), passed.alias("passed"))


def row_checks(df: DataFrame, minimum: int, bad: dict, rows_name: str = "row_count") -> DataFrame:
    """Q1, Q3, Q5 in one aggregate: more than ``minimum`` rows, and for each name
    of ``bad`` no row that meets its condition."""
    c = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(cond).alias(name) for name, cond in bad.items()])
    checks = [_check(rows_name, F.col("_rows"), minimum, F.col("_rows") > minimum)]
    checks += [_check(name, F.col(name), 0, F.col(name) == 0) for name in bad]
    return c.select(F.inline(F.array(*checks)))


def panel_identities(panel: DataFrame, windows: DataFrame, next_rows: DataFrame, spec: PanelSpec, size: int,
                     bad_window, bad_name: str) -> DataFrame:
    """Q8 and Q5 with one pass over each frame: ``window_identity`` and
    ``next_row_identity`` (name ``next_hour_identity``), and no row of ``windows``
    that meets ``bad_window``."""
    per = panel.groupBy(spec.entity).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("bigint")
    want = per.select(F.greatest(F.col("n") - size, F.lit(0)).alias("w"),
                      (F.col("n") - F.col(spec.entity).isNotNull().cast("int")).alias("x")).agg(
        F.coalesce(F.sum("w"), zero).alias("w"), F.coalesce(F.sum("x"), zero).alias("x"), zero.alias("bad"))
    got_w = windows.agg(F.negative(F.count(F.lit(1))).alias("w"), zero.alias("x"), F.count_if(bad_window).alias("bad"))
    got_x = next_rows.agg(zero.alias("w"), F.negative(F.count(F.lit(1))).alias("x"), zero.alias("bad"))
    d = want.unionByName(got_w).unionByName(got_x).agg(
        F.negative(F.sum("w")).alias("w"), F.negative(F.sum("x")).alias("x"), F.sum("bad").alias("bad"))
    return d.select(F.inline(F.array(*[
        _check(name, F.col(c), 0, F.col(c) == 0)
        for name, c in (("window_identity", "w"), ("next_hour_identity", "x"), (bad_name, "bad"))])))


def repeats_previous(spec: PanelSpec, key: str) -> Column:
    """Q8 without a shuffle of its own: whether a row has the ``key`` of the row
    before it in its entity. Over the panel's own window, so it shares its sort."""
    return F.coalesce(F.lag(F.struct(key)).over(spec.ordered()) == F.struct(key), F.lit(False))


def observe(df: DataFrame, bad: dict, label: str, name: str = "quality") -> tuple[DataFrame, Observation]:
    """Q1, Q3-Q5, Q8 as metrics of the pass that writes ``df``: row count, rows
    that meet each condition of ``bad``, rows of either class (0, 1) and of none.

    Place it under the write with no exchange in between: Spark then counts
    each partition once, also when tasks are repeated."""
    seen = Observation(name)
    y = F.col(label)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(f"bad_{n}") for n, c in bad.items()],
                      F.count_if(y == 0).alias("zeros"), F.count_if(y == 1).alias("ones"),
                      F.count_if((y != 0) & (y != 1)).alias("others")), seen


def observed_summary(spark, seen: Observation, minimum: int, rows_name: str = "row_count",
                     classes_name: str = "both_classes") -> DataFrame:
    """The check rows of ``observe`` once its pass has run, with ``all_passed``;
    no job. Both classes: 0 and 1 occur and nothing else."""
    m = seen.get
    kinds = sum(m[c] > 0 for c in ("zeros", "ones", "others"))
    rows = [(rows_name, float(m["rows"]), float(minimum), m["rows"] > minimum),
            (classes_name, float(kinds), 2.0, m["zeros"] > 0 and m["ones"] > 0 and m["others"] == 0)]
    rows += [(n[4:], float(v), 0.0, v == 0) for n, v in m.items() if n.startswith("bad_")]
    passed = sum(r[3] for r in rows)
    rows.append(("all_passed", float(passed), float(len(rows)), passed == len(rows)))
    return spark.createDataFrame(rows, CHECK_SCHEMA)


def summary(checks: list[DataFrame]) -> DataFrame:
    """Q9: union of check rows plus an ``all_passed`` row. The check rows (one for
    each check, so few) are gathered into one array, so that every check runs once."""
    u = checks[0]
    for c in checks[1:]:
        u = u.unionByName(c)
    one = u.agg(F.collect_list(F.struct("check_name", "observed", "threshold", "passed")).alias("c"))
    total = _check("all_passed", F.size(F.filter("c", lambda x: x["passed"])), 0,
                   F.forall("c", lambda x: F.coalesce(x["passed"], F.lit(True))))
    total = total.withField("threshold", F.size("c").cast("double"))
    return one.select(F.inline(F.concat(F.col("c"), F.array(total))))


def required_columns(df: DataFrame, columns: list[str], min_columns: int | None = None) -> list[tuple]:
    """Q2: required columns and minimum column count (schema only, no job)."""
    out = [(f"has_{c}", 1.0 if c in df.columns else 0.0, 1.0, c in df.columns) for c in columns]
    if min_columns is not None:
        out.append(("min_columns", float(len(df.columns)), float(min_columns), len(df.columns) >= min_columns))
    return out


def tables_exist(spark, names: list[str]) -> list[tuple]:
    """Q2: required tables registered in the catalog."""
    return [(f"table_{n}", 1.0 if spark.catalog.tableExists(n) else 0.0, 1.0,
             bool(spark.catalog.tableExists(n))) for n in names]


def assert_passed(summary_df: DataFrame) -> None:
    """Q9: raise (non-zero job exit) when any check failed."""
    failed = summary_df.filter(~F.col("passed") & (F.col("check_name") != "all_passed")).select("check_name").collect()
    if failed:
        raise AssertionError("quality checks failed: " + ", ".join(r[0] for r in failed))
