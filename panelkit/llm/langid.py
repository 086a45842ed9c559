"""Language ID: Bayesian fusion of text, markup, address suffix and host priors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.config import cut_lineage
from panelkit.llm.common import lookup, table, text_of
from panelkit.llm.ngram_bayes import class_counts, log_likelihoods, mean_scores

# The text counts as at most so many independent grams (a text's grams are far
# from independent); so the other evidence can speak where the text is short.
TEXT_GRAMS = 60
HOST_STRENGTH = 4.0  # pseudo-counts that a level takes from the level above it
DECLARED_STRENGTH = 4.0
MIN_POSTERIOR = 0.5
MIN_GRAMS = 3
# The model is bounded by so many languages x buckets; public identifiers of
# web text tell 100 to 200. More declared values are an error, none is dropped.
MAX_LANGUAGES = 1000


def train_text_model(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text"):
    """(languages, log-likelihood matrix) from all rows with a language. The
    languages are all those with text, however few rows they have; more than
    MAX_LANGUAGES are an error."""
    rows = labelled.select(F.lower(F.col(lang_col).cast("string")).alias("cls"), text_of(text_col).alias("text")) \
        .filter("cls is not null and cls <> '' and text <> ''")
    languages = sorted(r[0] for r in rows.select("cls").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} declared languages")
    if not languages:
        return [], None
    return languages, log_likelihoods(class_counts(rows, lower=True), languages)


def _plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where a lambda reads it
    (Spark computes what a lambda takes from outside again for each element)."""
    return F.transform(F.array(value), use)[0]


def _softmax(scores: Column) -> Column:
    e = _let(F.struct(scores.alias("s"), F.array_max(scores).alias("top")),
             lambda v: F.transform(v["s"], lambda x: F.exp(x - v["top"])))
    return _let(e, lambda e: _let(
        F.struct(e.alias("e"), F.aggregate(e, F.lit(0.0), lambda s, y: s + y).alias("size")),
        lambda v: F.transform(v["e"], lambda x: x / v["size"])))


def _totals(rows: DataFrame, keys: list[str], k: int, name: str) -> DataFrame:
    """Soft counts of the languages by key: arrays of length k, and the rows."""
    return rows.groupBy(*keys).agg(F.array(*[F.sum(F.col("q")[i]) for i in range(k)]).alias(name),
                                   F.count(F.lit(1)).alias(f"n_{name}"))


def _smoothed(counts: Column, own: Column, above: Column, strength: float) -> Column:
    """(counts - own + strength * above) / (their sum): a prior without the row itself."""
    less = F.zip_with(counts, own, lambda c, q: F.greatest(c - q, F.lit(0.0)))
    sized = F.struct(less.alias("less"), F.aggregate(less, F.lit(0.0), lambda s, x: s + x).alias("size"))
    return _let(sized, lambda v: F.zip_with(v["less"], above, lambda c, p: (c + strength * p) / (v["size"] + strength)))


def identify(pages: DataFrame, languages: list[str], model, id_cols: list[str],
             min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """Rows (id_cols, language, posterior, text_language, n_grams, rejected) for
    ``pages(id_cols, text, declared, suffix, host, domain)``.

    log posterior = text log-likelihood (per gram, as at most TEXT_GRAMS grams)
    + log P(declared | language) + log P(suffix | language) + log host prior.
    The likelihoods of declarations and suffixes and the host prior, smoothed
    host <- domain <- all, are grouped aggregates of the text's posteriors over
    all rows; a row's own share is taken out of its prior. Null declared,
    suffix, host or domain add no evidence. A row is rejected (language 'und')
    if its text has fewer than MIN_GRAMS grams and nothing is declared, or if no
    language reaches ``min_posterior``. Without a model all rows are rejected.
    Ties go to the language that sorts first. Repeated rows count each.
    """
    k = len(languages)
    if not k:
        return pages.select(*id_cols, F.lit("und").alias("language"), F.lit(0.0).alias("posterior"),
                            F.lit("und").alias("text_language"), F.lit(0).cast("bigint").alias("n_grams"),
                            F.lit(True).alias("rejected"))
    names = F.array(*[F.lit(x) for x in languages])
    evidence = [c for c in ("declared", "suffix", "host", "domain")]
    scored = mean_scores(pages.select(F.struct(*id_cols).alias("ids"),
                                      *[F.col(c).cast("string").alias(c) for c in evidence],
                                      text_of("text").alias("text")), model, lower=True)
    strength = F.least(F.col("n_grams"), F.lit(TEXT_GRAMS)).cast("double")
    scored = scored.withColumn("t", F.transform("ll", lambda x: x * strength)).drop("ll")
    scored = cut_lineage(scored.withColumn("q", _softmax(F.col("t"))))
    everything = _totals(scored, [], k, "a").first()
    total = everything["n_a"]
    overall = [(x + 1.0) / (total + k) for x in (everything["a"] or [])] if total else [1.0 / k] * k
    prior = F.array(*[F.lit(float(p)) for p in overall])

    hosts = _totals(scored.filter("host is not null"), ["host", "domain"], k, "h")
    domains = _totals(scored.filter("domain is not null"), ["domain"], k, "d")
    hosts = (lookup(hosts, domains, ["domain"], "n_d", total)
             .groupBy("host").agg(F.max_by("h", "n_h").alias("h"), F.max_by("d", "n_h").alias("d"),
                                  F.max("n_h").alias("n_h")))
    rows = lookup(scored, cut_lineage(hosts), ["host"], "n_h", total)
    rows = lookup(rows, cut_lineage(_totals(scored.filter("declared is not null"), ["declared"], k, "m")),
                  ["declared"], "n_m", total)
    rows = lookup(rows, cut_lineage(_totals(scored.filter("suffix is not null"), ["suffix"], k, "s")),
                  ["suffix"], "n_s", total)

    domain_prior = F.when(F.col("d").isNotNull(), _smoothed(F.col("d"), F.col("q"), prior, HOST_STRENGTH)) \
        .otherwise(prior)
    rows = rows.withColumn("above", domain_prior)
    host_prior = F.when(F.col("h").isNotNull(), _smoothed(F.col("h"), F.col("q"), F.col("above"), HOST_STRENGTH)) \
        .otherwise(F.col("above"))

    def likelihood(counts: str) -> Column:
        """log P(value | language), up to a constant of the row: soft count of the
        value among the language's rows, smoothed by the value's overall share."""
        size = F.col(f"n_{counts}").cast("double")
        own = F.zip_with(F.zip_with(F.col(counts), F.col("q"), lambda c, q: F.greatest(c - q, F.lit(0.0))), prior,
                         lambda c, p: F.log((c + DECLARED_STRENGTH * size / total)
                                            / (p * total + DECLARED_STRENGTH)))
        return F.when(F.col(counts).isNotNull(), own).otherwise(F.array(*[F.lit(0.0)] * k))

    fused = _plus(_plus(F.col("t"), F.transform(host_prior, lambda x: F.log(x))),
                  _plus(likelihood("m"), likelihood("s")))
    rows = rows.withColumn("post", _softmax(fused))
    best = F.array_max("post")
    bad = ((F.col("n_grams") < MIN_GRAMS) & F.col("declared").isNull()) | (best < min_posterior)
    return rows.select(
        *[F.col("ids")[c].alias(c) for c in id_cols], F.when(bad, F.lit("und")).otherwise(F.element_at(names, F.array_position("post", best).cast("int")))
        .alias("language"), best.alias("posterior"),
        F.element_at(names, F.array_position("q", F.array_max("q")).cast("int")).alias("text_language"),
        "n_grams", bad.alias("rejected"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """(page_id, text, declared, suffix, host, domain) of raw web pages. The text
    is what is left without scripts, styles, comments, tags and entities; null
    html or url give empty text or no evidence."""
    html = text_of("html")
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*+>", " ")
    text = F.regexp_replace(F.regexp_replace(text, r"&#?[A-Za-z0-9]{1,10};", " "), r"\s+", " ")
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    declared = F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b", 1))

    def some(c: Column) -> Column:
        return F.when(c != "", c)
    return pages.select("page_id", F.trim(text).alias("text"), some(declared).alias("declared"), some(host).alias("host")) \
        .select("page_id", "text", "declared", some(F.regexp_extract("host", r"([^.]+)$", 1)).alias("suffix"), "host",
                some(F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)).alias("domain"))


def op1(spark, sf_dir: str) -> DataFrame:
    """Language of every page; the text model is counted over all documents."""
    languages, model = train_text_model(table(spark, sf_dir, "documents"))
    return identify(page_evidence(table(spark, sf_dir, "pages")), languages, model, ["page_id"])
