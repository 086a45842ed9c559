"""Toxicity: class-conditional Kneser-Ney models over shared backoff counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.config import cut_lineage
from panelkit.llm.common import HashTable, blocks_of, codes_of, kept, map_arrow, table, text_of
from panelkit.llm.ngram_bayes import fit_softmax

ORDER = 5  # characters of an n-gram; 12 bits each in a key
BITS = 12
MASK = (1 << BITS) - 1
WINDOWS = (12, 48)  # characters of the windows whose best means are features
FEATURES = ("mean", "peak", "peak_long")
# The classifier is fitted on at most so many labelled rows of each class (drawn
# by a hash of the identifier): for the class counts, and for the calibration.
FIT_ROWS = 20_000
CALIBRATION_ROWS = 5_000


def fold(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(12-bit codes of the texts, lengths). Lower case; ORDER - 1 spaces before
    and one after each text; digits are 0, white space is one sort; code points
    from 0xF00 on share 256 codes by their low byte."""
    pad = " " * (ORDER - 1)
    texts = [f"{pad}{t.lower()} " for t in texts]
    c = codes_of(texts).astype(np.int64)
    c = np.where(c >= 0xF00, 0xF00 | (c & 0xFF), c)
    c[(c >= 48) & (c <= 57)] = 48
    c[(c < 32) | (c == 0x85) | (c == 0xA0)] = 32
    return c, np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))


def keys_of(c: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key of the n-gram that ends at each position, which positions count).
    The first ORDER - 1 positions of a text are its padding and do not count."""
    key = np.zeros(len(c), dtype=np.int64)
    for i in range(ORDER):
        shift = ORDER - 1 - i
        key[shift:] |= c[:len(c) - shift] << (BITS * shift) if shift else c
    counts = np.ones(len(c), dtype=bool)
    starts = np.cumsum(sizes) - sizes
    counts[(starts[:, None] + np.arange(ORDER - 1)).ravel()] = False
    return key, counts


def class_grams(rows: DataFrame) -> DataFrame:
    """(key, t, o): n-gram counts of ``rows(toxic, text)`` by class."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            toxic = np.array(b.column(0).to_pylist(), dtype=bool)
            for start, texts in blocks_of(b.column(1)):
                c, sizes = fold(texts)
                key, counts = keys_of(c, sizes)
                own = np.repeat(toxic[start:start + len(texts)], sizes)
                for is_toxic in (True, False):
                    k, n = np.unique(key[counts & (own == is_toxic)], return_counts=True)
                    zero = np.zeros(len(n), dtype=np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(k), pa.array(n if is_toxic else zero), pa.array(zero if is_toxic else n)],
                        ["key", "t", "o"])

    return (map_arrow(rows.select("toxic", "text"), run, "key bigint, t bigint, o bigint")
            .groupBy("key").agg(F.sum("t").alias("t"), F.sum("o").alias("o")))


def corpus_grams(rows: DataFrame) -> DataFrame:
    """(key): the different n-grams of all ``rows(text)``; tasks send each of
    theirs once (or once more when 4 million have come together)."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, fresh = np.empty(0, dtype=np.int64), []
        size = 0

        def merged():
            return np.unique(np.concatenate([seen, *fresh]))

        for b in it:
            for _, texts in blocks_of(b.column(0)):
                key, counts = keys_of(*fold(texts))
                u = np.unique(key[counts])
                fresh.append(u)
                size += len(u)
                if size > 2_000_000:
                    seen, fresh, size = merged(), [], 0
                    if len(seen) > 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(seen)], ["key"])
                        seen = seen[:0]
        seen = merged()
        if len(seen):
            yield pa.RecordBatch.from_arrays([pa.array(seen)], ["key"])

    return map_arrow(rows.select("text"), run, "key bigint").distinct()


def _discount(df: DataFrame, col: str) -> float:
    """Kneser-Ney discount n1 / (n1 + 2 n2) from the counts of counts."""
    r = df.agg(F.sum((F.col(col) == 1).cast("long")).alias("a"), F.sum((F.col(col) == 2).cast("long")).alias("b")).first()
    a, b = r["a"] or 0, r["b"] or 0
    return min(max(a / (a + 2 * b), 0.1), 0.9) if a else 0.5


def shared_backoff(grams: DataFrame) -> DataFrame:
    """(key, p): interpolated Kneser-Ney probability of the last of ORDER - 1
    characters given those before, from continuation counts (how many different
    characters precede an n-gram) over the whole corpus, order by order."""
    levels, cur = {}, grams
    for n in range(ORDER - 1, 0, -1):
        cur = cut_lineage(cur.groupBy(F.col("key").bitwiseAND((1 << BITS * n) - 1).alias("key"))
                          .agg(F.count(F.lit(1)).alias("n")))
        levels[n] = cur
    base = levels[1]
    d = _discount(base, "n")
    r = base.agg(F.sum("n"), F.count(F.lit(1))).first()
    size, kinds = r[0] or 1, r[1] or 0
    p = base.select("key", (F.greatest(F.col("n") - d, F.lit(0.0)) / size
                            + F.lit(d * kinds / size / (kinds + 1))).alias("p"))
    for n in range(2, ORDER):
        d = _discount(levels[n], "n")
        own = levels[n].withColumn("hist", F.shiftright("key", BITS)) \
            .withColumn("low", F.col("key").bitwiseAND((1 << BITS * (n - 1)) - 1))
        hist = own.groupBy("hist").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("kinds"))
        below = p.select(F.col("key").alias("low"), F.col("p").alias("q"))
        p = own.join(hist, "hist").join(below, "low").select(
            "key", ((F.greatest(F.col("n") - d, F.lit(0.0)) + d * F.col("kinds") * F.col("q")) / F.col("size")).alias("p"))
    return p


def ratio_tables(counts: DataFrame, backoff: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, r) and (hist, r): log p(toxic) / p(ordinary) of every n-gram that
    either class has, and of the backoff weights of every history that either
    has. p_class = (max(c - d, 0) + d * kinds * shared) / size; a history that a
    class has not seen is the shared distribution itself. For an n-gram that no
    class has, the shared probability cancels, so these two tables give every
    ratio exactly."""
    d = {c: _discount(counts, c) for c in ("t", "o")}
    own = counts.withColumn("hist", F.shiftright("key", BITS)) \
        .withColumn("low", F.col("key").bitwiseAND((1 << BITS * (ORDER - 1)) - 1))
    hist = cut_lineage(own.groupBy("hist").agg(
        *[F.sum(c).alias(f"size_{c}") for c in "to"],
        *[F.sum((F.col(c) > 0).cast("long")).alias(f"kinds_{c}") for c in "to"]))
    rows = own.join(hist, "hist").join(backoff.select(F.col("key").alias("low"), "p"), "low", "left")
    p = F.coalesce("p", F.lit(1e-6))

    def prob(c):
        some = (F.greatest(F.col(c) - d[c], F.lit(0.0)) + d[c] * F.col(f"kinds_{c}") * p) / F.col(f"size_{c}")
        return F.when(F.col(f"size_{c}") > 0, some).otherwise(p)

    def weight(c):
        return F.when(F.col(f"size_{c}") > 0, d[c] * F.col(f"kinds_{c}") / F.col(f"size_{c}")).otherwise(1.0)

    return (rows.select("key", F.log(prob("t") / prob("o")).cast("float").alias("r")),
            hist.select("hist", F.log(weight("t") / weight("o")).cast("float").alias("r")))


def share_tables(tables: tuple[DataFrame, DataFrame]):
    """The two ratio tables as a broadcast of arrays; they are bounded by the rows
    the classifier is fitted on."""
    import uuid
    arrays = []
    for t in tables:
        got = t.toArrow()
        arrays += [got.column(0).to_numpy(), got.column(1).to_numpy()]
    return tables[0].sparkSession.sparkContext.broadcast((uuid.uuid4().hex, arrays))


def features(rows: DataFrame, shared) -> DataFrame:
    """``rows`` (``text`` goes) with ``mean``, the log-likelihood of the toxic less
    that of the ordinary model per character, and ``peak`` and ``peak_long``, the
    largest such means over WINDOWS characters of the text. ``shared``: see
    share_tables."""
    others = [c for c in rows.columns if c != "text"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, (k1, r1, k2, r2) = shared.value
        mine = kept("toxicity")
        if name not in mine:
            mine.clear()
            mine[name] = HashTable(k1, r1), HashTable(k2, r2)
        grams, histories = mine[name]
        for b in it:
            means, peaks = [], [[] for _ in WINDOWS]
            for _, texts in blocks_of(b.column(b.num_columns - 1)):
                c, sizes = fold(texts)
                key, counts = keys_of(c, sizes)
                r, found = grams.get(key)
                left = np.flatnonzero(~found & counts)
                r[left] = histories.get(key[left] >> BITS)[0]
                r = np.where(counts, r, 0).astype(np.float64)
                starts = np.cumsum(sizes) - sizes
                n = sizes - (ORDER - 1)
                n_text = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
                total = np.add.reduceat(r, starts)
                csum = np.concatenate([[0.0], np.cumsum(r)])
                # windows that end inside the text and start no earlier than it
                ends = np.arange(len(r)) + 1
                first = np.repeat(starts, sizes)
                for window, into in zip(WINDOWS, peaks, strict=True):
                    sums = csum[ends] - csum[np.maximum(ends - window, first)]
                    into.append(np.where(n_text > 0, np.maximum.reduceat(sums, starts) / window, 0.0))
                means.append(np.where(n_text > 0, total / np.maximum(n, 1), 0.0))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], *(pa.array(np.concatenate(x) if x else np.empty(0)) for x in (means, *peaks))],
                [*others, *FEATURES])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*others).schema.fields)
    return map_arrow(rows.select(*others, "text"), run, f"{kinds}, " + ", ".join(f"{f} double" for f in FEATURES), "toxicity")


def draw(labels: DataFrame, limits: dict[int, int]) -> tuple[DataFrame, dict[int, float]]:
    """Rows of ``labels(id, cls)`` by a hash of the identifier, about 9/10 of the
    limit or all rows of each class; and the rates. Bounded, so it may be broadcast."""
    sizes = {r["cls"]: r["count"] for r in labels.filter(F.col("cls").isin(list(limits))).groupBy("cls").count().collect()}
    rates = {c: min(1.0, 0.9 * limits[c] / n) if n > limits[c] else 1.0 for c, n in sizes.items()}
    at = F.pmod(F.xxhash64(F.lit(29), "id"), F.lit(1 << 30)) / float(1 << 30)
    keep = F.lit(False)
    for c, rate in rates.items():
        keep = keep | ((F.col("cls") == c) & (at < rate))
    return labels.filter(keep), rates


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             fit_rows: int = FIT_ROWS, calibration_rows: int = CALIBRATION_ROWS) -> DataFrame:
    """One row per row of ``docs``: id_col, held_out, score, predicted, mean_ratio,
    peak_ratio, peak_long_ratio.

    ``labels(id_col, toxic)``: null toxic or identifier is no label; of several
    labels for one identifier the largest counts. crc32(identifier as text) mod 5
    = 0 is held out; 1 to 3 give the class counts, 4 calibrates the score, a
    logistic function of the length-normalised ratios. The continuation
    counts come from all texts of ``docs``. Empty and null texts get ratio 0,
    null identifiers are scored too (held_out null), repeated rows alike. With
    labels of one class or none, the score is the smoothed share of toxic ones.
    Other columns are not read.
    """
    part = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(5))
    named = (labels.select(F.col(id_col).cast("bigint").alias("id"), F.col("toxic").cast("int").alias("cls"))
             .filter("id is not null and cls in (0, 1)").groupBy("id").agg(F.max("cls").alias("cls"))
             .withColumn("part", part))
    fit, _ = draw(named.filter("part in (1, 2, 3)"), {0: fit_rows, 1: fit_rows})
    check, rates = draw(named.filter("part = 4"), {0: calibration_rows, 1: calibration_rows})
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text_of(text_col).alias("text"))
    sample = cut_lineage(rows.select("id").join(F.broadcast(fit.unionByName(check)), "id").distinct())
    sizes = {(r["fit"], r["cls"]): r["count"] for r in
             sample.groupBy((F.col("part") < 4).alias("fit"), "cls").count().collect()}
    out = rows.select("id", part.alias("part"), "text")
    if all(sizes.get((f, c), 0) for f in (True, False) for c in (0, 1)):
        chosen = rows.join(F.broadcast(sample.select("id", "cls", "part")), "id")
        counts = cut_lineage(class_grams(chosen.filter("part < 4").select((F.col("cls") == 1).alias("toxic"), "text")))
        tables = ratio_tables(counts, shared_backoff(corpus_grams(rows)))
        tables = share_tables(tuple(cut_lineage(t) for t in tables))
        seen = features(chosen.filter("part = 4").select("cls", "text"), tables).toPandas()
        y = seen["cls"].to_numpy(int)
        weight = np.array([1 / rates[c] for c in y])
        x = seen[list(FEATURES)].to_numpy()
        scale = x.std(axis=0) + 1e-9
        w = fit_softmax(x / scale, y, weight, 2)[1]
        scored = features(out, tables)
        z = F.lit(float(w[-1]))
        for f, c in zip(FEATURES, w[:-1] / scale, strict=True):
            z = z + F.col(f) * float(c)
        score = 1 / (1 + F.exp(-z))
    else:
        toxic, ordinary = (sum(n for (_, c), n in sizes.items() if c == k) for k in (1, 0))
        scored = out.drop("text").withColumns({f: F.lit(0.0) for f in FEATURES})
        score = F.lit((toxic + 0.5) / (toxic + ordinary + 1.0))
    return scored.select(F.col("id").alias(id_col), (F.col("part") == 0).alias("held_out"), score.alias("score"),
                         (score >= 0.5).cast("int").alias("predicted"), *[F.col(f).alias(f"{f}_ratio") for f in FEATURES])


def op2(spark, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
