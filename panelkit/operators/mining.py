"""Association mining (N1-N8) as DataFrame plans.

Transactions are first collapsed to distinct baskets with a weight (a hash
aggregate with map-side combine, so cost after it does not grow with row
count). Itemsets of size <= ``max_len`` are every subset of a basket,
enumerated by bitmask, summed by weight and filtered by support -- the same
set Apriori returns. Rules enumerate every non-empty proper subset of a
frequent itemset as antecedent (consequents of any size, unlike
``FPGrowthModel.associationRules``) and join supports by itemset key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit import constants as K


def transactions(df: DataFrame, event_cols: list[str] = K.EVENT_COLS, name: str = "items") -> DataFrame:
    """The non-null items of the event columns, in column order."""
    return df.withColumn(name, F.array_compact(F.array(*[F.col(c) for c in event_cols])))


def item_universe() -> list[str]:
    """Every label the event bins can emit, sorted."""
    labels = set()
    for _, rules, default in K.EVENT_BINS.values():
        labels.update(label for _, _, label in rules)
        if default is not None:
            labels.add(default)
    return sorted(labels)


def one_hot(df: DataFrame, items: str = "items", universe: list[str] | None = None) -> DataFrame:
    """One boolean column per item."""
    uni = universe or item_universe()
    return df.select("*", *[F.array_contains(F.col(items), F.lit(u)).alias(u) for u in uni])


def baskets(df: DataFrame, items: str = "items") -> DataFrame:
    """Distinct sorted baskets with weight ``w`` (number of transactions)."""
    return (df.select(F.array_sort(F.col(items)).alias("basket"))
            .groupBy("basket").agg(F.count(F.lit(1)).cast("double").alias("w")))


def _subsets(arr: str, mask: str, bit: int = 1) -> F.Column:
    """Elements of ``arr`` whose position bit in ``mask`` equals ``bit``."""
    return F.expr(f"filter({arr}, (x, i) -> shiftright({mask}, i) % 2 = {bit})")


def _small_subsets(basket: F.Column, max_len: int) -> F.Column:
    """All subsets of 1 to ``max_len`` elements, each once and in basket order:
    every level extends the sets of the one before by a later element."""
    last = F.size(basket) - 1
    level = F.transform(basket, lambda x, i: F.struct(i.alias("p"), F.array(x).alias("s")))
    levels = [level]
    for _ in range(max_len - 1):
        level = F.flatten(F.transform(
            F.filter(level, lambda e: e["p"] < last),
            lambda e: F.transform(F.sequence(e["p"] + 1, last), lambda q: F.struct(
                q.alias("p"), F.concat(e["s"], F.array(F.element_at(basket, q + 1))).alias("s")))))
        levels.append(level)
    return F.transform(F.concat(*levels), lambda e: e["s"])


def frequent_itemsets(df: DataFrame, items: str = "items", min_support: float = K.MIN_SUPPORT,
                      max_len: int = K.MAX_ITEMSET_LEN) -> DataFrame:
    """Itemsets (sorted arrays) with support >= ``min_support`` and size <= ``max_len``.

    Output: itemset, key (items joined by ', '), size, support.
    """
    b = baskets(df, items)
    # one scalar (the transaction count) from the partially aggregated baskets
    n_total = float(b.agg(F.sum("w")).first()[0] or 0.0)
    b = b.withColumn("_n", F.lit(n_total))
    subs = b.select(F.explode(_small_subsets(F.col("basket"), max_len)).alias("itemset"), "w", "_n")
    sets = subs.groupBy("itemset").agg(F.sum("w").alias("_c"), F.first("_n").alias("_n"))
    sets = sets.select("itemset", F.concat_ws(", ", "itemset").alias("key"),
                       F.size("itemset").alias("size"), (F.col("_c") / F.col("_n")).alias("support"))
    return sets.filter(F.col("support") >= F.lit(min_support))


def frequent_itemsets_tree(df: DataFrame, items: str = "items", min_support: float = K.MIN_SUPPORT,
                           max_len: int = K.MAX_ITEMSET_LEN) -> DataFrame:
    """N3 for large item universes and long baskets, by Spark's distributed
    FP-growth: each basket goes to the conditional trees of its items, and no
    subsets of a basket are listed. Same output and support as
    ``frequent_itemsets``; the driver holds the frequent items (at most mean
    basket size / ``min_support``). Sets larger than ``max_len`` are dropped
    after the trees, which still walk them: ``min_support`` has to be high
    enough that no large set of items is frequent.

    Repeated items of a basket count once, null items not at all; empty and
    null baskets count as transactions. An empty table has no itemsets.
    """
    from pyspark.ml.fpm import FPGrowth
    rows = df.select(F.array_distinct(F.array_compact(F.coalesce(F.col(items), F.array().cast("array<string>"))))
                     .alias("_b"))
    n = rows.count()
    lower = min_support * (1 - 1e-9)  # the exact comparison is the filter below
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sets = FPGrowth(itemsCol="_b", minSupport=lower, minConfidence=0.0, numPartitions=parts).fit(rows).freqItemsets
    sets = sets.filter(F.size("items") <= max_len).select(F.array_sort("items").alias("itemset"), "freq")
    sets = sets.select("itemset", F.concat_ws(", ", "itemset").alias("key"), F.size("itemset").alias("size"),
                       (F.col("freq") / F.lit(float(max(n, 1)))).alias("support"))
    return sets.filter(F.col("support") >= F.lit(min_support))


def itemset_sizes(itemsets: DataFrame) -> DataFrame:
    """Number of frequent itemsets per size."""
    return itemsets.groupBy("size").agg(F.count(F.lit(1)).alias("itemsets"))


def rules(itemsets: DataFrame, min_confidence: float = K.FALLBACK_CONFIDENCE) -> DataFrame:
    """Every split of each itemset (size >= 2) into antecedent and consequent.

    Output: antecedents, consequents (sorted arrays), their keys, support
    (of the union), confidence = s(I)/s(A), lift = confidence / s(C).
    """
    big = itemsets.filter(F.col("size") >= 2)
    splits = big.select("itemset", "support",
                        F.explode(F.sequence(F.lit(1), F.pow(F.lit(2), F.size("itemset")).cast("int") - 2)).alias("_m"))
    splits = splits.select(
        _subsets("itemset", "_m").alias("antecedents"),
        _subsets("itemset", "_m", 0).alias("consequents"),
        "support")
    splits = splits.select("*", F.concat_ws(", ", "antecedents").alias("ante_key"),
                           F.concat_ws(", ", "consequents").alias("cons_key"))
    # joined on the arrays: texts of different itemsets may be equal
    a = itemsets.select(F.col("itemset").alias("antecedents"), F.col("support").alias("ante_support"))
    c = itemsets.select(F.col("itemset").alias("consequents"), F.col("support").alias("cons_support"))
    r = splits.join(a, on="antecedents", how="inner").join(c, on="consequents", how="inner")
    r = r.select("antecedents", "consequents", "ante_key", "cons_key", "support",
                 (F.col("support") / F.col("ante_support")).alias("confidence"),
                 "cons_support")
    r = r.withColumn("lift", F.col("confidence") / F.col("cons_support")).drop("cons_support")
    return r.filter(F.col("confidence") >= F.lit(min_confidence))


def quality_rules(r: DataFrame, min_lift: float = K.MIN_LIFT) -> DataFrame:
    """Lift strictly above ``min_lift``."""
    return r.filter(F.col("lift") > F.lit(min_lift))


def concludes(target: str = K.TARGET_ITEM) -> F.Column:
    """Exact membership of the target in the consequents."""
    return F.array_contains(F.col("consequents"), F.lit(target))


def rules_with_fallback(itemsets: DataFrame, target: str = K.TARGET_ITEM,
                        primary: float = K.MIN_CONFIDENCE, fallback: float = K.FALLBACK_CONFIDENCE,
                        min_lift: float = K.MIN_LIFT) -> DataFrame:
    """Rules at ``primary`` confidence, unless none of them (lift > 1)
    concludes ``target``; then the whole set at ``fallback``.

    Rules are built once at the lower threshold; a scalar over the (small,
    bounded) rule table picks the threshold -- no driver-side branch.
    """
    low = quality_rules(rules(itemsets, min(primary, fallback)), min_lift)
    has = F.max(F.when(concludes(target) & (F.col("confidence") >= primary), 1).otherwise(0)).over(Window.partitionBy())
    chosen = F.when(has == 1, F.lit(primary)).otherwise(F.lit(fallback))
    return (low.withColumn("min_confidence", chosen)
            .filter(F.col("confidence") >= F.col("min_confidence")))


def target_rules(r: DataFrame, target: str = K.TARGET_ITEM) -> DataFrame:
    """Rules concluding the target, ranked by confidence (ties: lift, keys)."""
    t = r.filter(concludes(target))
    w = Window.orderBy(F.col("confidence").desc(), F.col("lift").desc(), "ante_key", "cons_key")
    return t.withColumn("rank", F.row_number().over(w))


def top_by_lift(r: DataFrame, k: int = 10) -> DataFrame:
    """H3: the k rules with highest lift (ties by keys); metrics rounded to 4."""
    top = r.orderBy(F.col("lift").desc(), "ante_key", "cons_key").limit(k)
    return top.select("ante_key", "cons_key", F.bround("support", 4).alias("support"),
                      F.bround("confidence", 4).alias("confidence"), F.bround("lift", 4).alias("lift"))


def rule_summary(transactions_df: DataFrame, itemsets: DataFrame, r: DataFrame,
                 target: str = K.TARGET_ITEM) -> DataFrame:
    """A10: long metric table (metric, value) for a mining run."""
    def one(df: DataFrame, name: str, value) -> DataFrame:
        return df.agg(value.cast("double").alias("value")).select(F.lit(name).alias("metric"), "value")

    return (one(transactions_df, "total_transactions", F.count(F.lit(1)))
            .unionByName(one(itemsets, "frequent_itemsets", F.count(F.lit(1))))
            .unionByName(one(r, "total_rules", F.count(F.lit(1))))
            .unionByName(one(r, "target_rules", F.sum(F.when(concludes(target), 1).otherwise(0))))
            .unionByName(one(r, "min_confidence", F.max("min_confidence"))))
