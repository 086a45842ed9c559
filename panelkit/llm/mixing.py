"""Mixing sources to target weights: soft domain membership, rates by
distributed projected-gradient least squares."""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.config import cut_lineage
from panelkit.llm.common import map_arrow, table, text_of
from panelkit.llm.ngram_bayes import class_counts, fit_softmax, log_likelihoods, mean_scores
from panelkit.llm.toxicity import draw

# Domains of the labelled table and the target share of each in the mixture.
DOMAINS = ("good", "low_quality", "toxic")
WEIGHTS = {"good": 0.88, "low_quality": 0.08, "toxic": 0.04}
# The classifier is fitted on at most so many labelled rows of each domain.
FIT_ROWS = 20_000
CALIBRATION_ROWS = 5_000
ROUNDS = 200
TOLERANCE = 1e-6
# Rows of one partition of the slim posterior table that the rounds go over.
SLIM_ROWS = 250_000


def posteriors(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               fit_rows: int = FIT_ROWS, calibration_rows: int = CALIBRATION_ROWS) -> DataFrame:
    """(id, text_hash, n_tokens, p): probabilities of DOMAINS for every row.

    ``labels(id_col, quality, toxic)``: toxic = 1 is toxic, else quality = 0 is
    low_quality, else good; nulls are no label; of several rows for one
    identifier the worst counts. Class-conditional n-gram likelihoods are fitted
    on four fifths of a bounded labelled sample and turned into probabilities by
    a softmax fitted on the rest (features: mean and peak ratios). Tokens are
    words between white space."""
    cls = F.when(F.col("toxic") == 1, F.lit(2)).when(F.col("quality") == 0, F.lit(1)) \
        .when((F.col("toxic") == 0) & (F.col("quality") == 1), F.lit(0))
    named = (labels.select(F.col(id_col).cast("bigint").alias("id"), cls.alias("cls"))
             .filter("id is not null and cls is not null").groupBy("id").agg(F.max("cls").alias("cls"))
             .withColumn("part", F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(5))))
    k = len(DOMAINS)
    fit, _ = draw(named.filter("part > 0"), dict.fromkeys(range(k), fit_rows))
    check, rates = draw(named.filter("part = 0"), dict.fromkeys(range(k), calibration_rows))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text_of(text_col).alias("text"))
    sample = cut_lineage(rows.select("id").join(F.broadcast(fit.unionByName(check)), "id").distinct())
    sizes = {(r["check"], r["cls"]): r["count"] for r in
             sample.groupBy((F.col("part") == 0).alias("check"), "cls").count().collect()}
    slim = rows.select("id", F.xxhash64("text").alias("text_hash"), "text")
    known = [c for c in range(k) if sizes.get((False, c), 0) and sizes.get((True, c), 0)]
    if len(known) < 2:
        share = [sum(n for (_, c), n in sizes.items() if c == d) + 1.0 for d in range(k)]
        p = F.array(*[F.lit(x / sum(share)) for x in share])
        words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("bigint")
        return slim.select("id", "text_hash", words.alias("n_tokens"), p.alias("p"))
    chosen = rows.join(F.broadcast(sample), "id")  # at most k * (fit + calibration) rows
    model = log_likelihoods(
        class_counts(chosen.filter("part > 0").select(F.col("cls").cast("string").alias("cls"), "text")
                     .filter(F.col("cls").isin([str(c) for c in known])), lower=False), [str(c) for c in known])
    seen = mean_scores(chosen.filter("part = 0").select("cls", "text"), model, lower=False, peaks=True).toPandas()
    seen = seen[seen["cls"].isin(known)]
    ll, peak = (np.array(seen[c].tolist()) for c in ("ll", "peak"))
    x = np.hstack([ll[:, 1:] - ll[:, :1], peak])
    y = np.array([known.index(c) for c in seen["cls"]])
    scale = x.std(axis=0) + 1e-9
    w = fit_softmax(x / scale, y, np.array([1 / rates[c] for c in seen["cls"]]), len(known))
    w[:, :-1] /= scale
    scored = mean_scores(slim, model, lower=False, peaks=True)
    some, m = F.col("n_grams") > 0, len(known) - 1
    parts = [F.when(some, F.col("ll")[j + 1] - F.col("ll")[0]).otherwise(0.0) for j in range(m)] + \
        [F.when(some, F.col("peak")[j]).otherwise(0.0) for j in range(m)]
    z = [sum((f * float(c) for f, c in zip(parts, v[:-1], strict=True)), F.lit(float(v[-1]))) for v in w]
    scored = scored.withColumn("z", F.array(*z))
    e = F.transform("z", lambda v: F.exp(v - F.array_max("z")))
    scored = scored.withColumn("e", e)
    total = F.aggregate("e", F.lit(0.0), lambda s, v: s + v)
    p = [F.col("e")[known.index(d)] / total if d in known else F.lit(0.0) for d in range(k)]
    return scored.select("id", "text_hash", F.col("n_words").alias("n_tokens"), F.array(*p).alias("p"))


def rates_of(p: np.ndarray, pulls: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(rates, extrapolated rates) after the given rounds of accelerated projected
    gradient, from 1.

    A rate only depends on the row's posteriors and on the pulls (one vector of
    domains per round), so nothing is kept per row between rounds."""
    rate = look = np.ones(len(p))
    t = 1.0
    for pull in pulls:
        new = np.maximum(look - p @ pull, 0.0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look = new + (t - 1) / t2 * (new - rate)
        rate, t = new, t2
    return rate, look


def fit_rates(members: DataFrame, targets: np.ndarray, rounds: int = ROUNDS,
              tolerance: float = TOLERANCE) -> list[np.ndarray]:
    """Pulls that solve min over rates r >= 0 of sum_d (sum_i r_i n_i p_id - T_d)^2
    by accelerated projected gradient in the metric of the tokens n_i (where the
    step 1 is safe: the p are probabilities). Each round is one Spark job that
    sums ``members(n_tokens, p)`` into as many numbers as there are domains. What is
    left after ``rounds`` (targets that no rates meet, say) is told by a warning."""
    spark, k = members.sparkSession, len(targets)
    size = float(members.agg(F.sum("n_tokens")).first()[0] or 0)
    pulls: list[np.ndarray] = []
    if not size:
        return pulls
    rows = members.select("n_tokens", "p")
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(pulls)

        def run(it: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total, settled = np.zeros(k), np.zeros(k)
            for b in it:
                p = b.column(1).values.to_numpy(zero_copy_only=False).reshape(-1, k)
                n = b.column(0).to_numpy().astype(float)
                rate, look = rates_of(p, shared.value)
                total += (look * n) @ p
                settled += (rate * n) @ p
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64())),
                                              pa.array([settled.tolist()], pa.list_(pa.float64()))], ["a", "b"])

        sums = map_arrow(rows, run, "a array<double>, b array<double>").agg(
            *[F.sum(F.col(c)[i]) for c in "ab" for i in range(k)]).first()
        reached, settled = np.array(sums[:k]), np.array(sums[k:])
        if np.abs(settled - targets).max() <= tolerance * size:
            break
        pulls = [*pulls, (reached - targets) / size]
    else:
        warnings.warn(f"rates after {rounds} rounds leave {np.abs(settled - targets).max():.0f} of {size:.0f} tokens "
                      "between a domain and its target", stacklevel=2)
    return pulls


def targets_of(have: np.ndarray, want: np.ndarray, total_tokens: float | None, alike: bool) -> np.ndarray:
    """Tokens that each domain shall have, of the ``have`` there are (see ``mix``);
    ``alike``: all rows have the same posteriors."""
    if not have.sum():
        return np.zeros(len(have))
    if alike:  # nothing to tell the rows apart by, so only their number can change
        return have if total_tokens is None else have * (total_tokens / have.sum())
    want = np.where(have > 0, want, 0.0)
    if not want.sum():
        raise ValueError("no row belongs to a domain that has a weight")
    want = want / want.sum()
    if total_tokens is not None:
        return want * total_tokens
    lead = int(want.argmax())
    return np.minimum(want * (have[lead] / want[lead]), have)


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None, total_tokens: float | None = None,
        id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS,
        calibration_rows: int = CALIBRATION_ROWS) -> DataFrame:
    """One row per row of ``docs``: id_col, text_hash, n_tokens, p_<domain>, rate, copies.

    The rates make the expected tokens of each domain (rate x tokens x
    posterior, summed) meet weight x ``total_tokens``. By default the domain of
    the largest weight is kept whole and sets the total; a domain too scarce for
    its weight is kept whole too and falls short of it, none is raised above what
    there is. Domains without mass are left out of the weights (an error if no
    weight is left). Where the labels tell no rows apart (fewer than two domains
    in both samples), all rows get the same rate: 1 by default. copies = rate
    rounded down or up by a hash of identifier and text, so the expectation is
    kept and runs agree; repeated rows get equal copies each. Null and empty
    texts have 0 tokens and get the rate of their posteriors. Weights are
    normalised; a domain without a weight has 0. Empty table: empty result.
    Other columns are not read.
    """
    want = np.array([float((weights or WEIGHTS).get(d, 0.0)) for d in DOMAINS])
    if (want < 0).any() or not want.sum():
        raise ValueError("weights must not be negative and not all zero")
    want = want / want.sum()
    members = posteriors(docs, labels, id_col, text_col, fit_rows, calibration_rows)
    n = docs.count()
    members = cut_lineage(members.repartition(max(1, -(-n // SLIM_ROWS))))
    k = len(DOMAINS)
    sums = members.agg(*[F.coalesce(F.sum(F.col("n_tokens") * F.col("p")[i]), F.lit(0.0)) for i in range(k)],
                       *[F.coalesce(F.min(F.col("p")[i]) == F.max(F.col("p")[i]), F.lit(True)) for i in range(k)]).first()
    targets = targets_of(np.array(sums[:k], dtype=float), want, total_tokens, alike=all(sums[k:]))
    pulls = members.sparkSession.sparkContext.broadcast(fit_rates(members, targets))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            p = b.column(3).values.to_numpy(zero_copy_only=False).reshape(-1, k)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rates_of(p, pulls.value)[0])],
                                             ["id", "text_hash", "n_tokens", "p", "rate"])

    rated = map_arrow(members, run, "id bigint, text_hash bigint, n_tokens bigint, p array<double>, rate double")
    chance = F.pmod(F.xxhash64(F.lit(43), "id", "text_hash"), F.lit(1 << 30)) / float(1 << 30)
    return rated.select(F.col("id").alias(id_col), "text_hash", "n_tokens",
                        *[F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(DOMAINS)], "rate",
                        F.floor(F.col("rate") + chance).cast("int").alias("copies"))


def op8(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
