"""Association-mining queries (N1-N8, H3) over the balanced event sample."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit import constants as K
from panelkit.functions import scalar as X
from panelkit.operators import mining, split
from panelkit.plans import oracle as O
from panelkit.plans.q_panel import features
from panelkit.plans.q_scalar import EVENTS_SQL
from panelkit.plans.registry import finish, query

HASH_SQL = "md5(concat(patient_id, '-', CAST(iculos AS VARCHAR)))"

BAL_CTES = O.FEATURE_CTES + [
    f"ev AS (SELECT patient_id, iculos, sepsislabel, {EVENTS_SQL} FROM feat)",
    f"r AS (SELECT *, row_number() OVER (PARTITION BY sepsislabel ORDER BY {HASH_SQL}) AS rn FROM ev)",
    "bs AS (SELECT * FROM r WHERE sepsislabel = 1 OR rn <= 3 * (SELECT sum(sepsislabel) FROM feat))",
    "nt AS (SELECT count(*) * 1e0 AS n FROM bs)",
    "it AS (SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT patient_id, iculos, {c} AS item FROM bs" for c in K.EVENT_COLS) + ") u WHERE item IS NOT NULL)",
]

ITEMSET_CTES = BAL_CTES + [
    "i1 AS (SELECT item AS a, count(*) AS c FROM it GROUP BY item)",
    "i2 AS (SELECT x.item AS a, y.item AS b, count(*) AS c FROM it x JOIN it y "
    "ON x.patient_id = y.patient_id AND x.iculos = y.iculos AND x.item < y.item GROUP BY 1, 2)",
    "i3 AS (SELECT x.item AS a, y.item AS b, z.item AS c3, count(*) AS c FROM it x "
    "JOIN it y ON x.patient_id = y.patient_id AND x.iculos = y.iculos AND x.item < y.item "
    "JOIN it z ON y.patient_id = z.patient_id AND y.iculos = z.iculos AND y.item < z.item GROUP BY 1, 2, 3)",
    "fi AS (SELECT a AS k, a AS a, NULL AS b, NULL AS c3, 1 AS size, c / n AS support FROM i1, nt WHERE c / n >= 0.05e0 "
    "UNION ALL SELECT a || ', ' || b, a, b, NULL, 2, c / n FROM i2, nt WHERE c / n >= 0.05e0 "
    "UNION ALL SELECT a || ', ' || b || ', ' || c3, a, b, c3, 3, c / n FROM i3, nt WHERE c / n >= 0.05e0)",
]

_SPLITS = [
    # (antecedent key expr, consequent key expr) over fi rows of size 2 / 3
    (2, "a", "b"), (2, "b", "a"),
    (3, "a", "b || ', ' || c3"), (3, "b", "a || ', ' || c3"), (3, "c3", "a || ', ' || b"),
    (3, "a || ', ' || b", "c3"), (3, "a || ', ' || c3", "b"), (3, "b || ', ' || c3", "a"),
]

RULE_CTES = ITEMSET_CTES + [
    "sp AS (" + " UNION ALL ".join(f"SELECT {ae} AS ante_key, {ce} AS cons_key, support FROM fi WHERE size = {sz}"
                                   for sz, ae, ce in _SPLITS) + ")",
    "ru AS (SELECT sp.ante_key, sp.cons_key, sp.support, sp.support / fa.support AS confidence, "
    "sp.support / fa.support / fc.support AS lift FROM sp JOIN fi fa ON sp.ante_key = fa.k JOIN fi fc ON sp.cons_key = fc.k)",
    "rq AS (SELECT * FROM ru WHERE confidence >= 0.1e0 AND lift > 1e0)",
    "hs AS (SELECT max(CASE WHEN confidence >= 0.3e0 AND list_contains(string_split(cons_key, ', '), 'SEPSIS') "
    "THEN 1 ELSE 0 END) AS has FROM rq)",
    "rf AS (SELECT rq.*, CASE WHEN has = 1 THEN 0.3e0 ELSE 0.1e0 END AS min_confidence FROM rq, hs "
    "WHERE confidence >= CASE WHEN has = 1 THEN 0.3e0 ELSE 0.1e0 END)",
]


def balanced_events(spark, sf_dir):
    f = features(spark, sf_dir).select("patient_id", "iculos", "sepsislabel", *X.event_bins())
    return split.balanced_sample(f, ["patient_id", "iculos"], "sepsislabel", K.NEGATIVES_PER_POSITIVE)


def itemsets(spark, sf_dir):
    return mining.frequent_itemsets(mining.transactions(balanced_events(spark, sf_dir)))


def chosen_rules(spark, sf_dir):
    return mining.rules_with_fallback(itemsets(spark, sf_dir))


@query("transactions", "N1 I2 E3",
       O.with_(BAL_CTES, "SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, concat_ws(', ', "
               + ", ".join(K.EVENT_COLS) + ") AS items FROM bs"))
def q_transactions(spark, sf_dir):
    t = mining.transactions(balanced_events(spark, sf_dir))
    return finish(t.select("patient_id", "iculos", F.concat_ws(", ", "items").alias("items")))


@query("one_hot_items", "N2",
       O.with_(BAL_CTES, "SELECT patient_id, CAST(iculos AS BIGINT) AS iculos, "
               + ", ".join(f"coalesce(list_contains([{', '.join(K.EVENT_COLS)}], '{u}'), false) AS {u}"
                           for u in mining.item_universe()) + " FROM bs"))
def q_one_hot(spark, sf_dir):
    t = mining.transactions(balanced_events(spark, sf_dir))
    return finish(mining.one_hot(t).drop("items", "sepsislabel", *K.EVENT_COLS))


@query("frequent_itemsets", "N3",
       O.with_(ITEMSET_CTES, "SELECT k AS key, CAST(size AS BIGINT) AS size, round(support, 6) AS support FROM fi"))
def q_frequent_itemsets(spark, sf_dir):
    return finish(itemsets(spark, sf_dir).select("key", "size", "support"))


@query("itemset_sizes", "N4",
       O.with_(ITEMSET_CTES, "SELECT CAST(size AS BIGINT) AS size, CAST(count(*) AS BIGINT) AS itemsets FROM fi GROUP BY size"))
def q_itemset_sizes(spark, sf_dir):
    return finish(mining.itemset_sizes(itemsets(spark, sf_dir)))


@query("association_rules", "N5 N6",
       O.with_(RULE_CTES, "SELECT ante_key, cons_key, round(support, 6) AS support, round(confidence, 6) AS confidence, "
               "round(lift, 6) AS lift FROM ru WHERE confidence >= 0.3e0 AND lift > 1e0"))
def q_association_rules(spark, sf_dir):
    r = mining.quality_rules(mining.rules(itemsets(spark, sf_dir), K.MIN_CONFIDENCE))
    return finish(r.select("ante_key", "cons_key", "support", "confidence", "lift"))


@query("rules_with_fallback", "N7 N6 B6",
       O.with_(RULE_CTES, "SELECT ante_key, cons_key, round(support, 6) AS support, round(confidence, 6) AS confidence, "
               "round(lift, 6) AS lift, round(min_confidence, 6) AS min_confidence FROM rf"))
def q_rules_with_fallback(spark, sf_dir):
    r = chosen_rules(spark, sf_dir)
    return finish(r.select("ante_key", "cons_key", "support", "confidence", "lift", "min_confidence"))


@query("target_rules", "N8 B6 H3",
       O.with_(RULE_CTES, "SELECT ante_key, cons_key, round(confidence, 6) AS confidence, round(lift, 6) AS lift, "
               "CAST(row_number() OVER (ORDER BY confidence DESC, lift DESC, ante_key, cons_key) AS BIGINT) AS rank "
               "FROM rf WHERE list_contains(string_split(cons_key, ', '), 'SEPSIS')"))
def q_target_rules(spark, sf_dir):
    t = mining.target_rules(chosen_rules(spark, sf_dir))
    return finish(t.select("ante_key", "cons_key", "confidence", "lift", "rank"))


@query("top_rules_by_lift", "H3 N8 E13",
       O.with_(RULE_CTES, "SELECT ante_key, cons_key, " + O.bround_sql("support", 4) + " AS support, "
               + O.bround_sql("confidence", 4) + " AS confidence, " + O.bround_sql("lift", 4) + " AS lift "
               "FROM rf ORDER BY rf.lift DESC, ante_key, cons_key LIMIT 10"))
def q_top_rules_by_lift(spark, sf_dir):
    return finish(mining.top_by_lift(chosen_rules(spark, sf_dir), 10))


@query("rule_summary", "A10 N3 N7",
       O.with_(RULE_CTES, "SELECT 'total_transactions' AS metric, round((SELECT n FROM nt), 6) AS value "
               "UNION ALL SELECT 'frequent_itemsets', CAST(count(*) AS DOUBLE) FROM fi "
               "UNION ALL SELECT 'total_rules', CAST(count(*) AS DOUBLE) FROM rf "
               "UNION ALL SELECT 'target_rules', CAST(sum(CASE WHEN list_contains(string_split(cons_key, ', '), 'SEPSIS') "
               "THEN 1 ELSE 0 END) AS DOUBLE) FROM rf "
               "UNION ALL SELECT 'min_confidence', round(max(min_confidence), 6) FROM rf"))
def q_rule_summary(spark, sf_dir):
    t = balanced_events(spark, sf_dir)
    its = mining.frequent_itemsets(mining.transactions(t))
    return finish(mining.rule_summary(t, its, mining.rules_with_fallback(its)))


@query("rule_floors", "Q7 N7 H3",
       O.with_(RULE_CTES + ["tr AS (SELECT * FROM rf ORDER BY lift DESC, ante_key, cons_key LIMIT 10)",
                            "m AS (SELECT 'total_rules' AS metric, CAST(count(*) AS DOUBLE) AS value FROM rf "
                            "UNION ALL SELECT 'top_rules', CAST(count(*) AS DOUBLE) FROM tr)",
                            "t AS (SELECT 'total_rules' AS metric, 50e0 AS bound UNION ALL SELECT 'top_rules', 0e0)"],
               "SELECT m.metric, round(m.value, 6) AS value, round(t.bound, 6) AS bound, m.value > t.bound AS passed "
               "FROM m JOIN t ON m.metric = t.metric"))
def q_rule_floors(spark, sf_dir):
    """Q7 for the mining run: more than 50 rules and a non-empty top list."""
    from panelkit.operators import quality
    r = chosen_rules(spark, sf_dir)
    top = mining.top_by_lift(r, 10)
    m = (r.agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.lit("total_rules").alias("metric"), "value")
         .unionByName(top.agg(F.count(F.lit(1)).cast("double").alias("value"))
                      .select(F.lit("top_rules").alias("metric"), "value")))
    return finish(quality.metric_floors(m, [("total_rules", float(K.FLOOR_RULES), "min"), ("top_rules", 0.0, "min")]))


# ------------------------------------------- large item universe: suppliers of an order

BASKET_SUPPORT = 4e-4
BASKET_CONFIDENCE = 0.01
SUP = "4e-4"
BASKET_CTES = [
    "it AS (SELECT DISTINCT l_orderkey AS b, 'S' || lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS item FROM lineitem)",
    "nt AS (SELECT count(DISTINCT b) * 1e0 AS n FROM it)",
    "i1 AS (SELECT item AS a, count(*) AS c FROM it GROUP BY item)",
    "i2 AS (SELECT x.item AS a, y.item AS b, count(*) AS c FROM it x JOIN it y ON x.b = y.b AND x.item < y.item "
    "GROUP BY 1, 2)",
    "i3 AS (SELECT x.item AS a, y.item AS b, z.item AS c3, count(*) AS c FROM it x "
    "JOIN it y ON x.b = y.b AND x.item < y.item JOIN it z ON y.b = z.b AND y.item < z.item GROUP BY 1, 2, 3)",
    f"fi AS (SELECT a AS k, a AS a, NULL AS b, NULL AS c3, 1 AS size, c / n AS support FROM i1, nt WHERE c / n >= {SUP} "
    f"UNION ALL SELECT a || ', ' || b, a, b, NULL, 2, c / n FROM i2, nt WHERE c / n >= {SUP} "
    f"UNION ALL SELECT a || ', ' || b || ', ' || c3, a, b, c3, 3, c / n FROM i3, nt WHERE c / n >= {SUP})",
]
BASKET_RULE_CTES = BASKET_CTES + [
    "sp AS (" + " UNION ALL ".join(f"SELECT {ae} AS ante_key, {ce} AS cons_key, support FROM fi WHERE size = {sz}"
                                   for sz, ae, ce in _SPLITS) + ")",
    "ru AS (SELECT sp.ante_key, sp.cons_key, sp.support, sp.support / fa.support AS confidence, "
    "sp.support / fa.support / fc.support AS lift FROM sp JOIN fi fa ON sp.ante_key = fa.k JOIN fi fc ON sp.cons_key = fc.k)",
]


def supplier_itemsets(spark, sf_dir):
    """Suppliers that deliver to the same orders: one basket an order, the universe grows with the data."""
    from panelkit.sources.tables import read_table
    lines = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_suppkey"])
    item = F.concat(F.lit("S"), F.lpad(F.col("l_suppkey").cast("string"), 8, "0"))
    baskets = lines.groupBy("l_orderkey").agg(F.collect_set(item).alias("items"))
    return mining.frequent_itemsets_tree(baskets, "items", BASKET_SUPPORT)


@query("basket_itemsets", "N3 N4",
       O.with_(BASKET_CTES, "SELECT k AS key, CAST(size AS BIGINT) AS size, round(support, 6) AS support FROM fi"))
def q_basket_itemsets(spark, sf_dir):
    return finish(supplier_itemsets(spark, sf_dir).select("key", "size", "support"))


@query("basket_rules", "N3 N5 N6",
       O.with_(BASKET_RULE_CTES, "SELECT ante_key, cons_key, round(support, 6) AS support, round(confidence, 6) AS confidence, "
               f"round(lift, 6) AS lift FROM ru WHERE confidence >= {BASKET_CONFIDENCE!r}e0 AND lift > 1e0"))
def q_basket_rules(spark, sf_dir):
    sets = supplier_itemsets(spark, sf_dir).cache()
    r = mining.quality_rules(mining.rules(sets, BASKET_CONFIDENCE))
    return finish(r.select("ante_key", "cons_key", "support", "confidence", "lift"))
