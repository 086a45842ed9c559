"""Mergeable distinct counts (F7) against exact ones."""

from pyspark.sql import functions as F

from panelkit.operators import aggregate as agg
from panelkit.plans.q_stats import daily_sketches, q_distinct_users_by_month

from conftest import SF_CHECK

# four standard errors of 1.04 / sqrt(2^14), and one for small counts
WITHIN = 4 * 1.04 / 2 ** 7


def test_merged_days_equal_one_sketch_and_are_near_the_exact_count(spark):
    """200,000 users, each on several of 30 days: the union counts a user once."""
    df = spark.range(0, 600_000, 1, 8).selectExpr("id % 200000 AS user", "cast(id % 30 AS int) AS day")
    daily = agg.distinct_sketches(df, "user", ["day"])
    merged = agg.merged_distinct(daily).first()
    whole = agg.merged_distinct(agg.distinct_sketches(df, "user", [])).first()
    assert merged["rows"] == 600_000
    assert abs(merged["distinct_values"] / 200_000 - 1) < WITHIN
    assert abs(merged["distinct_values"] / whole["distinct_values"] - 1) < WITHIN


def test_new_days_are_added_without_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "sketches")
    for day, lo, hi in ((1, 0, 500), (2, 250, 750), (3, 0, 100)):
        df = spark.range(lo, hi).selectExpr("id AS user", f"{day} AS day")
        agg.distinct_sketches(df, "user", ["day"]).write.mode("append").parquet(path)
    got = agg.merged_distinct(spark.read.parquet(path)).first()
    assert got["rows"] == 1100 and abs(got["distinct_values"] - 750) <= 750 * WITHIN + 1


def test_months_of_events(spark):
    got = {r["month"]: r for r in q_distinct_users_by_month(spark, SF_CHECK).collect()}
    ev = spark.read.parquet(f"{SF_CHECK}/events.parquet").withColumn("month", F.date_format("ts", "yyyy-MM"))
    want = {r["month"]: r for r in ev.groupBy("month").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("u"))
            .collect()}
    assert set(got) == {*want, "all"}
    for m, r in want.items():
        assert got[m]["rows"] == r["n"] and abs(got[m]["distinct_values"] - r["u"]) <= r["u"] * WITHIN + 1
    assert daily_sketches(spark, SF_CHECK).select("day").distinct().count() == daily_sketches(spark, SF_CHECK).count()


def test_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (1, "a"), (2, None)], "day int, user string")
    sk = agg.distinct_sketches(df, "user", ["day"])
    got = {r["day"]: (r["rows"], r["distinct_values"]) for r in agg.merged_distinct(sk, ["day"]).collect()}
    assert got == {1: (3, 1), 2: (1, 0)}
    assert agg.merged_distinct(sk.limit(0), ["day"]).count() == 0
