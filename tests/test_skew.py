"""Skew-safe window plan: equal to the plain plan, bounded window groups."""

from pyspark.sql import functions as F

from panelkit.operators import skew, windows
from panelkit.operators.panel import PanelSpec
from panelkit.plans.check import compare
from panelkit.sources.tables import event_vitals, read_table

SF = "/root/testdata/sf0.01"


def hot_rows(spark):
    """Events of sf0.01 with every third user folded into one hot entity
    (about a third of all rows), the rest unchanged."""
    ev = read_table(spark, SF, "events")
    ev = ev.withColumn("user_id", F.when(F.col("user_id") % 3 == 0, F.lit(999999)).otherwise(F.col("user_id")))
    return event_vitals(ev)


def test_hot_entity_share(spark):
    rows = hot_rows(spark)
    share = rows.filter(F.col("patient_id") == "p999999").count() / rows.count()
    assert 0.25 < share < 0.45


def test_skew_safe_features_equal_plain_plan(spark):
    rows = hot_rows(spark)
    spec = PanelSpec("patient_id", ("ts", "event_id"))
    plain_panel = rows.withColumn("iculos", windows.ordinal(spec).cast("int")).drop("ts", "event_id")
    plain = windows.feature_table(plain_panel, PanelSpec("patient_id", ("iculos",)))
    safe = skew.feature_table(rows, "patient_id", ["ts", "event_id"], "iculos", chunk_rows=300)
    ok, msg = compare(safe.toPandas(), plain.toPandas())
    assert ok, msg


def test_window_groups_are_bounded(spark):
    rows = hot_rows(spark)
    chunk = 300
    imputed, chunked = skew.ordinal_and_impute(rows, "patient_id", ["ts", "event_id"], ["hr"], ["lactate"],
                                               "iculos", chunk)
    assert chunked
    halo, _ = skew.with_halo(imputed.drop("ts", "event_id"), "patient_id", "iculos", chunk, back=5, forward=1)
    biggest = halo.groupBy("_pk2").count().agg(F.max("count")).first()[0]
    assert biggest <= chunk + 6
    hot_total = rows.filter(F.col("patient_id") == "p999999").count()
    assert hot_total > 5 * chunk


def test_no_hot_entities_uses_one_exchange(spark):
    rows = event_vitals(read_table(spark, "/root/testdata/sf0.001", "events"))
    out = skew.feature_table(rows, "patient_id", ["ts", "event_id"], "iculos", chunk_rows=10_000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_lead_and_lags_on_chunked_panel_equal_plain(spark):
    rows = hot_rows(spark)
    spec = PanelSpec("patient_id", ("ts", "event_id"))
    plain_panel = rows.withColumn("iculos", windows.ordinal(spec).cast("int")).drop("ts", "event_id")
    plain = windows.feature_table(plain_panel, PanelSpec("patient_id", ("iculos",)))
    safe = skew.feature_table(rows, "patient_id", ["ts", "event_id"], "iculos", chunk_rows=300)
    pspec = PanelSpec("patient_id", ("iculos",))
    lead_plain = windows.lead_target(plain, pspec).select("patient_id", "iculos", "hr_next_hour")
    lead_safe = skew.per_entity(safe, "patient_id", "iculos", lambda d, s: windows.lead_target(d, s),
                                back=0, forward=1, hot=True, chunk_rows=300)
    ok, msg = compare(lead_safe.select("patient_id", "iculos", "hr_next_hour").toPandas(), lead_plain.toPandas())
    assert ok, msg
    win_plain = windows.sliding_windows(plain, pspec, "hr", 6)
    win_safe = skew.per_entity(safe, "patient_id", "iculos",
                               lambda d, s: windows.sliding_windows(d, s, "hr", 6, ordinal="iculos",
                                                                    keep=("patient_id",)),
                               back=6, forward=0, hot=True, chunk_rows=300)
    ok, msg = compare(win_safe.toPandas(), win_plain.toPandas())
    assert ok, msg
    assert skew.has_hot_entities(rows, "patient_id", 300)


def test_orders_panel_chunked_equals_plain(spark):
    """Long-tailed panel with tied dates: ordinal in 3-row time chunks and lags
    over 8-row ordinal chunks equal the plain windows."""
    from panelkit.operators.panel import ORDER_PANEL
    from panelkit.sources.tables import panel_from_orders
    df = panel_from_orders(spark, SF)
    plain = windows.sliding_windows(df, ORDER_PANEL, "o_totalprice", 6).drop("o_orderdate")
    numbered, chunked = skew.ordinal_and_impute(df, "o_custkey", ["o_orderdate", "o_orderkey"], [], [], "seq",
                                                chunk_rows=3)
    assert chunked
    safe = skew.per_entity(
        numbered, "o_custkey", "seq",
        lambda d, s: windows.sliding_windows(d, s, "o_totalprice", 6, ordinal="seq", keep=("o_custkey", "o_orderkey")),
        back=6, forward=0, hot=True, chunk_rows=8).drop("seq", "o_orderdate")
    ok, msg = compare(safe.toPandas(), plain.toPandas())
    assert ok, msg
