"""PII: exact base patterns, then bootstrapped contextual extraction.
DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.config import cut_lineage
from panelkit.llm.common import lookup, table, text_of

KINDS = ("email", "ip", "card", "phone")

# The base patterns. They match what the plain forms match; the
# possessive quantifiers and the look-behinds only keep the engine from trying
# again inside a run that has failed already (\G: right after the last match).
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a pattern to be worth trying.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}

OCTET = r"0*(?:[0-9]|[1-9][0-9]|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

# Looser forms of identifiers, which count only in a trusted context: mail
# addresses in other spellings, hexadecimal groups, numbers of 7 digits or more.
LOOSE = (r"(?:\G|(?<![^\s<>\"'(),;@]))[^\s@<>\"'(),;]++@[^\s@<>\"'(),;]++"
         r"|(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+"
         r"|(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"
         r"|(?<![0-9A-Za-z])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+(?![0-9A-Za-z])")
# The looser form a discovered identifier of a kind must have.
FORMS = {
    "email": r"@|[\[(](?:at|AT)[\])]",
    "ip": r"^(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}$|^[0-9]++(?:\.[0-9]++){3}$",
    "card": r"^[^0-9@]*+(?:[0-9][^0-9@]*+){12,19}+$",
    "phone": r"^[^0-9@]*+(?:[0-9][^0-9@]*+){7,15}+$",
}
CONTEXT = 48  # characters on either side in which the context words are looked for
ROUNDS = 3
MIN_CONFIDENCE = 0.8
MIN_SEEDS = 3  # different seed instances that a pattern needs

SPAN = "struct<start:int,kind:int,end:int,token:string,left:string,right:string>"


# Long lists are worked through in parts of so many entries.
PART = 256


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, not once for every use in a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _parts(items: Column) -> Column:
    """A list (not empty) cut into lists of PART entries."""
    last = ((F.size(items) - 1) / PART).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(items, c * PART + 1, F.lit(PART)))


def _length(items: Column) -> Column:
    return F.aggregate(items, F.lit(0), lambda a, x: a + x["gap"] + F.length(x["token"]))


def _matches(text: Column, pattern: str, kind: int) -> Column:
    """Leftmost non-overlapping matches as structs; positions are code points, found
    by adding up the lengths of the gaps between matches and of the matches: over
    parts, then over the part before each match. (A fold that collects its result
    is no use: Spark copies the fold's state in every step.)"""
    def items(v):
        n = F.size(v["found"])
        both = F.zip_with(F.slice(v["gaps"], 1, n), v["found"], lambda g, t: F.struct(
            F.length(g).alias("gap"), t.alias("token"), F.right(g, F.lit(CONTEXT)).alias("left")))
        return F.zip_with(both, F.slice(v["gaps"], 2, n), lambda x, g: F.struct(
            x["gap"].alias("gap"), x["token"].alias("token"), x["left"].alias("left"),
            F.left(g, F.lit(CONTEXT)).alias("right")))

    def part_spans(q):
        return F.transform(q["part"], lambda x, j: _let(
            q["base"] + _length(F.slice(q["part"], 1, j)) + x["gap"], lambda start: F.struct(
                start.alias("start"), F.lit(kind).alias("kind"), (start + F.length(x["token"])).alias("end"),
                x["token"].alias("token"), x["left"].alias("left"), x["right"].alias("right"))))

    def spans(w):
        return F.flatten(F.transform(w["parts"], lambda part, c: _let(
            F.struct(part.alias("part"), F.aggregate(F.slice(w["lengths"], 1, c), F.lit(0), lambda a, x: a + x).alias("base")),
            part_spans)))

    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
                     F.split(text, pattern, -1).alias("gaps"))
    return _let(found, lambda v: F.when(F.size(v["found"]) > 0, _let(items(v), lambda i: _let(_parts(i), lambda p: _let(
        F.struct(p.alias("parts"), F.transform(p, _length).alias("lengths")), spans))))
        .otherwise(F.array().cast(f"array<{SPAN}>")))


def _clear_of(loose: Column, base: Column) -> Column:
    """The loose spans that no base span overlaps; base spans are looked at in parts
    whose reach overlaps."""
    def parts(b):
        return F.when(F.size(b) > 0, F.transform(_parts(F.array_sort(b)), lambda p: F.struct(
            F.array_min(F.transform(p, lambda s: s["start"])).alias("low"),
            F.array_max(F.transform(p, lambda s: s["end"])).alias("high"), p.alias("part"))))

    def free(v):
        return F.filter(v["loose"], lambda s: ~F.exists(v["base"], lambda k: (k["low"] < s["end"]) & (
            k["high"] > s["start"]) & F.exists(k["part"], lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))))

    return _let(F.struct(loose.alias("loose"), _let(base, parts).alias("base")),
                lambda v: F.when(v["base"].isNull(), v["loose"]).otherwise(free(v)))


def _luhn(digits: Column) -> Column:
    """Do the digits pass Luhn's check?"""
    n = F.length(digits)
    terms = F.transform(F.sequence(F.lit(1), n), lambda i: F.when(
        (n - i) % 2 == 0, F.substr(digits, i, F.lit(1)).cast("int")).otherwise(
        F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                     F.substr(digits, i, F.lit(1)).cast("int") + 1)))
    return F.aggregate(terms, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, token: Column) -> Column:
    digits = F.regexp_replace(token, "[^0-9]", "")
    if kind == "ip":
        return token.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _find(text: Column, kind: str) -> Column:
    number = KINDS.index(kind) + 1
    wanted = text.rlike("[0-9]") if not NEEDS[kind] else text.contains(NEEDS[kind])
    return F.when(wanted, F.filter(_matches(text, PATTERNS[kind], number), lambda s: _valid(kind, s["token"]))) \
        .otherwise(F.array().cast(f"array<{SPAN}>"))


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One pass over the texts: (id, h, email, ip, card, phone, loose), arrays of spans."""
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))
    rows = rows.select("id", "h", "text", *[_find(F.col("text"), k).alias(k) for k in KINDS])
    base = F.concat(*KINDS)
    clear = _clear_of(_matches(F.col("text"), LOOSE, 0), base)
    loose = F.when(F.col("text").rlike(r"[0-9@]|[\[(](?:at|AT)[\])]"), clear).otherwise(F.array().cast(f"array<{SPAN}>"))
    return rows.select("id", "h", *KINDS, loose.alias("loose"))


def _contexts(s: Column) -> Column:
    """The lexical patterns around a span: word before; two words before; word
    before and word after. Lower case, digits as #."""
    def tidy(c):
        return F.regexp_replace(F.regexp_replace(F.lower(c), "[0-9]+", "#"), r"\s+", " ")
    one = tidy(F.regexp_extract(s["left"], r"(?:^|\s)(\S+)\s*$", 1))
    two = tidy(F.regexp_extract(s["left"], r"(?:^|\s)(\S+\s+\S+)\s*$", 1))
    after = tidy(F.regexp_extract(s["right"], r"^\s*(\S+)", 1))
    return F.filter(F.array(
        F.when(one != "", F.concat(F.lit("1 "), one)), F.when(two != "", F.concat(F.lit("2 "), two)),
        F.when((one != "") & (after != ""), F.concat(F.lit("3 "), one, F.lit(" _ "), after))),
        lambda p: p.isNotNull())


def bootstrap(scanned: DataFrame, rounds: int = ROUNDS, min_confidence: float = MIN_CONFIDENCE,
              min_seeds: int = MIN_SEEDS) -> DataFrame:
    """(id, h, start, kind, end) of identifiers that trusted contexts discover.

    The graph joins contexts and different instances (lower-case tokens). Each
    round scores a context for a kind by the mean of its instances' scores
    (seeds: 1, the rest: what the last round gave) over one instance more than
    it has, and trusts it from ``min_confidence`` on if ``min_seeds`` different
    seeds stand in it; an instance's score is the noisy-or of its trusted
    contexts. Only grouped sums and skew-safe look-ups over the graph."""
    items = F.flatten(F.array(*[F.transform(k, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lower(s["token"]).alias("token"),
        _contexts(s).alias("contexts"))) for k in (*KINDS, "loose")]))
    seen = cut_lineage(scanned.filter(" + ".join(f"size({k})" for k in (*KINDS, "loose")) + " > 0")
                       .select("id", "h", F.explode(items).alias("s")).select("id", "h", "s.*"))
    names = [f"s{k}" for k in range(1, len(KINDS) + 1)]
    edges = seen.select(F.explode("contexts").alias("context"), "token", "kind").groupBy("context", "token").agg(
        *[F.max((F.col("kind") == k).cast("double")).alias(f"s{k}") for k in range(1, len(KINDS) + 1)])
    edges = cut_lineage(edges.withColumn("seed", F.greatest(*names) > 0))
    total = edges.count()
    scores = None
    for _ in range(rounds):
        known = edges
        if scores is not None:
            known = lookup(edges.select("context", "token", "seed", *[F.col(n).alias(f"b{n}") for n in names]),
                           scores, ["token"], "n", total)
            known = known.select("context", "token", "seed", *[
                F.greatest(F.col(f"b{n}"), F.coalesce(n, F.lit(0.0))).alias(n) for n in names])
        contexts = known.groupBy("context").agg(
            F.count(F.lit(1)).alias("n"),
            *[(F.sum(n) / (F.count(F.lit(1)) + 1)).alias(f"c{n}") for n in names],
            *[F.sum((F.col("seed") & (F.col(n) == 1)).cast("int")).alias(f"k{n}") for n in names])
        contexts = cut_lineage(contexts.select("context", "n", *[
            F.when((F.col(f"c{n}") >= min_confidence) & (F.col(f"k{n}") >= min_seeds), F.col(f"c{n}"))
            .otherwise(0.0).alias(f"c{n}") for n in names]).filter(F.greatest(*[f"c{n}" for n in names]) > 0))
        reached = lookup(edges.filter(~F.col("seed")).select("context", "token"), contexts, ["context"], "n", total)
        scores = cut_lineage(reached.filter("n is not null").groupBy("token").agg(
            F.count(F.lit(1)).alias("n"),
            *[(1 - F.exp(F.sum(F.log1p(-F.least(F.col(f"c{n}"), F.lit(0.999)))))).alias(n) for n in names]))
    # occurrences in a trusted context, of the kind and the looser form
    loose = seen.filter("kind = 0").select("id", "h", "start", "end", "token", F.explode("contexts").alias("context"))
    hits = lookup(loose, contexts, ["context"], "n", total).filter("n is not null").drop("n")
    sized = scores.select("token", "n", *names)
    hits = lookup(hits, sized, ["token"], "n", total)
    kind = F.lit(None).cast("int")
    for k, name in reversed(list(enumerate(KINDS, 1))):
        good = ((F.col(f"cs{k}") > 0) & (F.col(f"s{k}") >= min_confidence) & F.col("token").rlike(FORMS[name]))
        kind = F.when(good, F.lit(k)).otherwise(kind)
    return (hits.withColumn("kind", kind).filter("kind is not null")
            .groupBy("id", "h", "start", "end").agg(F.min("kind").alias("kind"))
            .select("id", "h", "start", "kind", "end"))


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS,
             min_confidence: float = MIN_CONFIDENCE, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """One row per row of ``docs``: id_col, n_email, n_ip, n_card, n_phone (base
    spans), base_sha256, spans (base and discovered), n_discovered, and the
    spans themselves (``found``: start, kind number, end).

    Positions count code points, ends are exclusive. Null texts count as empty
    (no spans; base_sha256 of the empty string). Spans of different kinds may
    overlap. Rows repeated with the same identifier (null too) and text get the
    same spans. Empty table: empty result. Other columns are not read.
    """
    scanned = cut_lineage(scan(docs, id_col, text_col))
    extra = bootstrap(scanned, rounds, min_confidence, min_seeds).groupBy("id", "h").agg(
        F.collect_list(F.struct("start", "kind", "end")).alias("more"))
    short = F.concat(*[F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"),
                                                        s["end"].alias("end"))) for k in KINDS])
    rows = scanned.select("id", "h", short.alias("base"), *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS])
    # null identifiers join as such
    def keyed(d):
        return d.withColumn("no_id", F.col("id").isNull()).withColumn("id", F.coalesce("id", F.lit(0)))
    out = keyed(rows).join(keyed(extra), ["id", "no_id", "h"], "left")
    more = F.coalesce("more", F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    return out.select(
        F.when(~F.col("no_id"), F.col("id")).alias(id_col), *[f"n_{k}" for k in KINDS],
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.concat("base", more)).alias("spans"), F.size(more).cast("bigint").alias("n_discovered"),
        F.array_sort(F.concat("base", more)).alias("found"))


def op10(spark, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents")).drop("found")
