"""Training-data operators against brute force, libraries and planted cases."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from panelkit.llm import (bpe, chat, common, embed_dedup, exact_dedup, langid, mixing, ngram_bayes, pii, queries, simhash,
                          token_count, toxicity)

TOK = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)


EDGES = [(1, None), (2, ""), (3, " "), (4, "a"), (4, "a"), (None, "a"), (None, None), (5, "x y " * 30000),
         (6, "é 😀 a@b.co  \n\n"), (6, "other text")]


def duck(sql, **views):
    import duckdb
    con = duckdb.connect()
    for name, frame in views.items():
        con.register(name, frame)
    return con.execute(sql).fetchall()


# --- byte-level BPE -------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(TOK.path("byte_bpe_multi_50k.tiktoken"))


def test_bpe_equals_tiktoken(ranks):
    import tiktoken
    c = bpe.BytePairCodec(ranks, TOK.PATTERN)
    enc = tiktoken.Encoding("own", pat_str=TOK.PATTERN, mergeable_ranks=c.ranks, special_tokens={})
    rnd = random.Random(3)
    texts = ["", " ", "  ", "a b  c \nd", " a\n b", "a b c   d", "x\x1c y \x85z", "a" * 9000, "ab" * 4000, "😀" * 400]
    texts += ["".join(rnd.choice("aab  \n \x1c1.'sé") for _ in range(50)) for _ in range(1500)]
    texts += ["".join(chr(rnd.randrange(32, 0x3000)) for _ in range(3000))]
    for t in texts:
        ids = c.encode(t)
        assert ids == enc.encode_ordinary(t)
        assert c.decode(np.array(ids, dtype=np.int32))[0].tobytes() == t.encode()
    with pytest.raises(ValueError):
        c.decode(np.array([10**7]))


def test_bpe_lanes_equal_the_queue_of_one_pretoken(ranks):
    """Side by side or alone: the same ids, also with equal pairs and overlaps."""
    c = bpe.BytePairCodec(ranks, TOK.PATTERN)
    rng = random.Random(3)
    words = {bytes(rng.choice(b"aaabetns ri\xc3\xa9") for _ in range(rng.randint(2, bpe.LANE_BYTES)))
             for _ in range(3000)}
    words |= {b"a" * n for n in range(2, bpe.LANE_BYTES + 1)} | {b"ab" * n for n in range(1, bpe.LANE_BYTES // 2)}
    words = sorted(w for w in words if w not in c.ranks)
    assert c.lanes.merge(words) == [c.packed(w) for w in words]
    assert c.lanes.merge(words[:1]) == [c.packed(words[0])]


def test_bpe_memory_of_two_generations():
    m = bpe.Memory(2)
    for k in "abc":
        m.put(k, (1,))
    assert set(m.young) == {"c"} and m.older("a") == (1,) and "a" in m.young
    m.put("x" * (bpe.MEMORY_LENGTH + 1), (1,))
    assert len(m.young) <= 2


def test_bpe_edges_and_round_trip(spark, ranks):
    df = docs_of(spark, EDGES).withColumn("ids", F.lit("clash"))
    got = bpe.decode(bpe.encode(df, ranks, TOK.PATTERN), ranks, TOK.PATTERN).collect()
    assert sorted((r["doc_id"] or 0, bytes(r["decoded"]).decode()) for r in got) == \
        sorted((i or 0, t or "") for i, t in EDGES)
    digests = bpe.encode_digests(df, TOK.path("byte_bpe_multi_50k.tiktoken"), TOK.PATTERN).collect()
    want = {hashlib.sha256((t or "").encode()).hexdigest() for _, t in EDGES}
    assert {r["decoded_sha256"] for r in digests} == want and len(digests) == len(EDGES)
    assert bpe.encode(df.limit(0), ranks, TOK.PATTERN).count() == 0


# --- token counts ---------------------------------------------------------------------------------------------

def test_token_counts_equal_the_library(spark):
    import sentencepiece
    from tokenizers import Tokenizer, models, pre_tokenizers
    path = TOK.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    vocab = [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]
    lib = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=True))
    lib.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    texts = [r["text"] for r in common.table(spark, SF_SMALL, "documents").collect()]
    texts += ["", " ", "a ", " a", "  a  b ", "\n\n", "😀😀 x▁y", "日本語 テキスト", "\x00\x01"]
    df = docs_of(spark, list(enumerate(texts)))
    got = {r["doc_id"]: r["n_tokens"] for r in token_count.token_counts(df, path).collect()}
    assert got == {i: len(lib.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
    assert {(r["doc_id"], r["n_tokens"]) for r in token_count.token_counts(docs_of(spark, EDGES[:2]), path).collect()} \
        == {(1, 0), (2, 0)}


def test_viterbi_ties_keep_the_longest_last_piece():
    c = token_count.UnigramCounter([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", 0.0)], False)
    assert c.best("▁ab")[1] == 2  # ▁ + ab ties with ▁ + a + b
    assert c.best("▁zz")[1:] == (2, 2)  # without byte pieces a run of unknowns is one piece


# --- chat -----------------------------------------------------------------------------------------------------

def test_chat_prefixes_copies_and_edges(spark, monkeypatch):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"),
            (2, 0, "user", "hi"), (2, 1, "assistant", "yo"), (2, 2, "user", "more"),
            (3, 0, "user", "hi"), (3, 1, "assistant", "yo"), (3, 2, "user", "more"),
            (4, 0, "user", "yo"), (4, 0, "user", "yo"), (5, 0, "user", None), (6, 0, "user", ""),
            (7, None, None, "n"), (7, 3, "user", "hi"), (None, 0, "user", "lost")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, pos int")
    want = None
    for turns in (512, 1, 2):
        monkeypatch.setattr(chat, "TURNS", turns)
        got = chat.format_chats(df).orderBy("conv_id", "part").collect()
        whole = {}
        for r in got:
            whole.setdefault((r["conv_id"], r["n_turns"], r["copies"]), []).append(r["rendered"])
        whole = {k: "".join(v) for k, v in whole.items()}
        want = want or whole
        assert whole == want
    assert set(want) == {(2, 3, 2), (4, 1, 1), (5, 1, 1), (6, 1, 1), (7, 2, 1)}
    assert chat.format_chats(df.limit(0)).count() == 0


# --- exact dedup ----------------------------------------------------------------------------------------------

@pytest.mark.parametrize("trie_bytes", [exact_dedup.TRIE_BYTES, 300])
@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_dedup_brute_force(spark, keep, trie_bytes):
    rnd = random.Random(1)
    rows = EDGES + [(100 + i, rnd.choice(["same text", "ab", "ac", "abc", "é" * 9])) for i in range(300)]
    df = docs_of(spark, rows).repartition(5)
    got = exact_dedup.exact_dedup(df, keep=keep, trie_bytes=trie_bytes).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    want = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        owner = (min if keep == "smallest" else max)(known) if known else None
        want += [(i, owner, len(ids), i == owner, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    assert exact_dedup.exact_dedup(df.limit(0)).count() == 0


def test_trie_splits_edges():
    t = exact_dedup.Trie(least=True)
    words = [b"abc", b"abd", b"ab", b"abc", b"", b"xyz", b"abcde"]
    for i, w in enumerate(words):
        t.insert((0, 0), w, 10 - i, 1)
    got = {w: (o, n) for w, o, n in t.take((0, 0))}
    assert got == {b"abc": (7, 2), b"abd": (9, 1), b"ab": (8, 1), b"": (6, 1), b"xyz": (5, 1), b"abcde": (4, 1)}
    assert not t.roots


# --- SimHash --------------------------------------------------------------------------------------------------

def plain_print(text):
    import xxhash
    w = text.encode().lower().split()
    s = [b" ".join(w[i:i + 3]) for i in range(max(len(w) - 2, 1))] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if sum(v >> b & 1 for v in h) * 2 > len(h))


def components(ids, linked):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in linked:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("bucket_rows", [simhash.BUCKET_ROWS, 3])
def test_simhash_brute_force(spark, bucket_rows):
    rnd = random.Random(2)
    base = [[rnd.choice("alpha beta gamma delta eps zeta eta theta".split()) for _ in range(120)] for _ in range(6)]
    rows = [(1, None), (2, "  "), (3, "One"), (4, "one"), (5, "one two"), (5, "one two")]
    for k, words in enumerate(base):
        for i in range(25):
            w = list(words)
            if i % 3:
                w[rnd.randrange(len(w))] = rnd.choice(["new", "odd", "far"])
            rows.append((100 * (k + 1) + i, " ".join(w)))
    got = simhash.simhash_dedup(docs_of(spark, rows), bucket_rows=bucket_rows).collect()
    prints = {i: plain_print(t or "") for i, t in rows}
    ids = sorted(prints)
    want = components(ids, [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 3])
    assert len(got) == len(rows) and len(set(want.values())) < len(ids) - 20
    assert all(int(r["fingerprint"], 16) == prints[r["doc_id"]] for r in got)
    assert all(r["component_id"] == want[r["doc_id"]] for r in got)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert simhash.simhash_dedup(docs_of(spark, rows).limit(0)).count() == 0


def test_pivot_filter_loses_no_pair():
    rnd = np.random.default_rng(0)
    fps = rnd.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = fps[rnd.integers(0, 40, 200)] ^ (np.uint64(1) << rnd.integers(0, 60, 200).astype(np.uint64))
    fps = np.unique(np.concatenate([fps, near]))
    got = {tuple(sorted(p)) for i, j in simhash.near_pairs(fps, 3, simhash.pivot_fingerprints())
           for p in zip(i.tolist(), j.tolist(), strict=True)}
    n = len(fps)
    assert got == {(a, b) for a in range(n) for b in range(a + 1, n) if int(fps[a] ^ fps[b]).bit_count() <= 3}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = dict(common.connected_components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**dict.fromkeys(range(0, 61), 0), **dict.fromkeys(range(100, 140), 100)}


def test_lookup_with_a_hot_key_and_nulls(spark):
    rows = spark.createDataFrame([(i, None if i % 7 == 0 else i % 3) for i in range(300)], "id long, k long")
    found = rows.filter("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = common.lookup(rows, found, ["k"], "n", 300).collect()
    sizes = dict(found.collect())
    assert len(got) == 300 and all(r["n"] == sizes.get(r["k"]) for r in got)


# --- embeddings -----------------------------------------------------------------------------------------------

@pytest.mark.parametrize("block_rows,label_rows", [(2048, 1024), (16, 40)])
def test_embeddings_brute_force(spark, block_rows, label_rows):
    rnd = np.random.default_rng(5)
    centre = rnd.normal(size=(30, 8))
    rows = []
    for i in range(400):
        v = centre[i % 30] + rnd.normal(size=8) * (0.05 if i % 2 else 0.3)
        rows.append((i, [float(x) for x in v.astype(np.float32)], i % 30 % 3))
    rows += [(1000 + i, rows[5][1], 2) for i in range(40)]
    bad = [(2000, None, 1), (2001, [0.0] * 8, 1), (2002, [float("nan")] * 8, 1), (2003, [float("inf")] * 8, 1),
           (2004, rows[0][1], None), (2005, [None] * 8, 1), (2006, [], 1), (2007, rows[0][1][:4], 0)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r for r in embed_dedup.embedding_dedup(df, block_rows=block_rows, label_rows=label_rows).collect()}
    x = np.array([r[1] for r in rows])
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    lab, ids = np.array([r[2] for r in rows]), [r[0] for r in rows]
    near = (x @ x.T >= 0.98) & (lab[:, None] == lab[None, :])
    np.fill_diagonal(near, False)
    want = components(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near), strict=True)])
    assert near.sum() > 1000
    assert [got[i]["n_links"] for i in ids] == near.sum(axis=1).tolist()
    assert all(got[i]["component_id"] == want[i] and got[i]["kept"] == (want[i] == i) for i in ids)
    assert all(got[b[0]]["n_links"] == 0 and got[b[0]]["component_id"] == b[0] and got[b[0]]["kept"] for b in bad)
    assert embed_dedup.embedding_dedup(df.limit(0)).count() == 0


# --- PII ------------------------------------------------------------------------------------------------------

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(t):
    def good(kind, m):
        d = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(x) <= 255 for x in m.split("."))
        if kind == "card":
            s = sum(v if i % 2 == 0 else 2 * v - 9 * (v > 4) for i, v in enumerate(map(int, reversed(d))))
            return 14 <= len(d) <= 19 and s % 10 == 0
        return kind == "email" or 10 <= len(d) <= 15
    found = sorted((m.start(), n, m.end()) for n, k in enumerate(BASE) for m in re.finditer(BASE[k], t) if good(k, m.group()))
    return ",".join(f"{list(BASE)[n]}:{a}:{b}" for a, n, b in found)


def test_pii_base_spans(spark):
    texts = ["", None, "a@b.c_d@e.f x@y.z.w. q@w 1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.255", "+1 2 3+44 20 7946 0958++1(2)",
             "😀 é a@b.co 4111 1111 1111 1111 4111-1111-1111-1112 +1 (743) 555-3824", "a" * 3000 + "@b" + ".c" * 20000,
             "7" * 5000, "1.1." * 3000]
    df = docs_of(spark, [*enumerate(texts), (None, texts[4]), (None, texts[4])])
    got = pii.find_pii(df.withColumn("spans", F.lit(1))).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        t = texts[4] if r["doc_id"] is None else texts[r["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(plain_spans(t or "").encode()).hexdigest()
        assert r["n_discovered"] == 0 and r["spans"] == plain_spans(t or "")
    assert pii.find_pii(df.limit(0)).count() == 0


def test_pii_addresses_with_zero_parts(spark):
    texts = ["10.0.0.1", "0.0.0.0", "at 192.168.0.1, 127.0.0.1", "000.0.00.255", "256.0.0.1", "0.0.0.256", "0" * 3000 + ".0.0.1",
             "1.2.3.00400 10.00.010.0100"]
    for r in pii.find_pii(docs_of(spark, enumerate(texts))).collect():
        t = texts[r["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(plain_spans(t).encode()).hexdigest()
        assert r["n_ip"] == plain_spans(t).count("ip:")
    assert [plain_spans(t).count("ip:") for t in texts] == [1, 1, 2, 1, 0, 0, 1, 1]


def test_pii_many_matches_in_one_text(spark):
    """Positions are right over many parts, for every kind and beside loose matches."""
    rnd = random.Random(8)
    kinds = ["a{0}@b{0}.co", "10.{1}.3.{1}", "+49 30 55{0}12345 ", "4111 1111 1111 1111,", "é{0}", "x{0}@host", "12-34-{0}-999",
             "😀 {0}.{0}.{0}.{0}"]
    texts = [" ".join(rnd.choice(kinds).format(i, i % 256) for i in range(n)) for n in (255, 256, 257, 1025, 20_000)]
    for r in pii.find_pii(docs_of(spark, enumerate(texts)), min_seeds=10**6).collect():
        assert r["base_sha256"] == hashlib.sha256(plain_spans(texts[r["doc_id"]]).encode()).hexdigest()


def test_pii_loose_matches_beside_base_spans(spark):
    rnd = random.Random(9)
    def spans(n, width):
        at, out = 0, []
        for _ in range(n):
            at += rnd.randint(0, 4)
            out.append((at, at + rnd.randint(1, width)))
            at = out[-1][1]
        return out
    for n in (0, 1, 255, 256, 257, 700):
        base, loose = [(a, 1 + k, b) for k in range(2) for a, b in spans(n, 9)], [(a, 0, b) for a, b in spans(400, 5)]
        df = spark.createDataFrame([([(*x, "t", "", "") for x in loose], [(*x, "t", "", "") for x in base])],
                                   f"loose array<{pii.SPAN}>, base array<{pii.SPAN}>")
        got = [(s["start"], s["kind"], s["end"]) for s in df.select(
            pii._clear_of(F.col("loose"), F.col("base")).alias("x")).first()["x"]]
        assert got == [s for s in loose if not any(b[0] < s[2] and s[0] < b[2] for b in base)]


def test_pii_contexts_discover_unseen_identifiers(spark):
    rows = [(i, f"please reach me mail: user{i}@site{i}.org today") for i in range(12)]
    rows += [(50, "so mail: jane@intranet now"), (51, "the code 1234567 is no identifier"),
             (52, "call phone: 743 555 3824 at night")]
    rows += [(60 + i, f"call phone: +1 743 555 38{i:02d} at night") for i in range(12)]
    got = {r["doc_id"]: r for r in pii.find_pii(docs_of(spark, rows)).collect()}
    text = dict(rows)
    assert got[50]["spans"] == f"email:{text[50].index('jane')}:{text[50].index(' now')}"
    assert got[52]["spans"] == f"phone:{text[52].index('743')}:{text[52].index(' at')}"
    assert got[51]["spans"] == "" and sum(r["n_discovered"] for r in got.values()) == 2


def test_native_operators_plan_no_python(spark):
    for df in (queries.queries()["op4_chat_formatting"](spark, SF_SMALL), pii.op10(spark, SF_SMALL)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- language, toxicity, mixing -------------------------------------------------------------------------------

def test_language_of_pages_and_edges(spark):
    docs = common.table(spark, SF_SMALL, "documents")
    languages, model = langid.train_text_model(docs)
    assert languages == ["de", "en", "es", "fr"]
    text = {r["lang"]: r["text"] for r in docs.filter("n_chars > 1000").collect()}
    rows = [(i, text[la], d, None, None, None) for i, (la, d) in enumerate([("de", None), ("fr", "fr"), ("es", "en"), ("en", "en")])]
    rows += [(10, None, None, None, None, None), (11, "", "fr", "fr", "a.fr", "a.fr"), (12, "12", None, None, None, None)]
    rows += [(20, "le", "fr", "fr", "a.fr", "a.fr")] * 3
    df = spark.createDataFrame(rows, "h long, text string, declared string, suffix string, host string, domain string")
    got = {r["h"]: r for r in langid.identify(df, languages, model, ["h"]).collect()}
    assert [got[i]["language"] for i in range(4)] == ["de", "fr", "es", "en"]
    assert got[10]["rejected"] and got[10]["language"] == "und" and not got[20]["rejected"]
    assert langid.identify(df.limit(0), languages, model, ["h"]).count() == 0
    assert all(r["rejected"] for r in langid.identify(df, [], None, ["h"]).collect())
    pages = langid.op1(spark, SF_SMALL).collect()
    assert len(pages) == common.table(spark, SF_SMALL, "pages").count()


def test_language_held_out(spark):
    docs = common.table(spark, SF_SMALL, "documents")
    train, test = docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1")
    languages, model = langid.train_text_model(train)
    rows = test.select("doc_id", "text", *[F.lit(None).cast("string").alias(c) for c in ("declared", "suffix", "host", "domain")])
    got = langid.identify(rows, languages, model, ["doc_id"]).join(test, "doc_id")
    n, right = got.agg(F.count("*"), F.sum((F.col("language") == F.col("lang")).cast("int"))).first()
    assert right / n > 0.95


def test_language_of_a_rare_language(spark, monkeypatch):
    rnd = random.Random(5)
    main = "the house and river of a green stone walk slowly under light".split()
    rare = "zwoq kixu vuzhy qarri xolm pyqua wazzik".split()
    rows = [(i, " ".join(rnd.choice(main) for _ in range(20)), "en", None, None) for i in range(3000)]
    rows += [(5000 + i, " ".join(rnd.choice(rare) for _ in range(40)), "QX", None, None) for i in range(2)]
    rows += [(6000, "", "empty", None, None)]
    docs = docs_of(spark, []).union(spark.createDataFrame(rows, DOCS))
    languages, model = langid.train_text_model(docs)
    assert languages == ["en", "qx"] and model.shape == (2, ngram_bayes.BUCKETS)
    page = spark.createDataFrame([(1, " ".join(rare * 4), "qx", "qx", "a.qx", "a.qx"), (2, " ".join(main * 2), "en", "en", "a.en", "a.en")],
                                 "h long, text string, declared string, suffix string, host string, domain string")
    got = {r["h"]: r for r in langid.identify(page, languages, model, ["h"]).collect()}
    assert [got[i]["language"] for i in (1, 2)] == ["qx", "en"]
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 1)
    with pytest.raises(ValueError):
        langid.train_text_model(docs)


def test_language_of_many_languages(spark):
    """More classes than are counted at once, each with letters of its own."""
    text = [" ".join(chr(0x4E00 + 40 * i + j % 40) + chr(0x4E00 + 40 * i + (j * 7) % 40) for j in range(60)) for i in range(70)]
    names = [f"l{i:02d}" for i in range(70)]
    docs = spark.createDataFrame([(i, t, names[i], None, None) for i, t in enumerate(text)], DOCS)
    languages, model = langid.train_text_model(docs)
    assert languages == names
    rows = docs.select("doc_id", "text", *[F.lit(None).cast("string").alias(c) for c in ("declared", "suffix", "host", "domain")])
    got = {r["doc_id"]: r["language"] for r in langid.identify(rows, languages, model, ["doc_id"]).collect()}
    assert got == dict(enumerate(names))


def toxic_corpus(spark, n=400):
    rnd = random.Random(4)
    words = "the a of river stone house tree green walk slow light paper north".split()
    rows, labels = [], []
    for i in range(n):
        w = [rnd.choice(words) for _ in range(80)]
        bad = i % 4 == 0
        if bad:
            w[rnd.randrange(80)] = "grobian" + rnd.choice(["o", "en", "ulu", "ish", "xa"])
            w[rnd.randrange(80)] = "grobian" + rnd.choice(["o", "en", "ulu", "ish", "xa"])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity_held_out_and_edges(spark):
    rows, labels = toxic_corpus(spark)
    rows += [(9001, None), (9002, ""), (None, "a"), (9003, "the a of " * 9000), (9004, "the grobiankk of")]
    labels += [(9002, None, None), (None, 1, 1), (9003, 1, 0), (9003, 1, 0)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs_of(spark, rows), lab).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    held = [by[i] for i, _, _ in labels[:400] if by[i]["held_out"]]
    assert len(held) > 50 and all(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held)
    assert by[9004]["predicted"] == 1 and by[9003]["predicted"] == 0  # an unseen ending; a long text
    one = toxicity.toxicity(docs_of(spark, rows[:5]), lab.filter("toxic = 0")).collect()
    assert {r["predicted"] for r in one} == {0}
    assert toxicity.toxicity(docs_of(spark, []), lab).count() == 0


def test_kneser_ney_sums_to_one(spark):
    grams = toxicity.corpus_grams(docs_of(spark, [(1, "abracadabra banana"), (2, "a bad cab")]).select("text"))
    p = toxicity.shared_backoff(grams).collect()
    chars = {r["key"] & toxicity.MASK for r in p}
    total = {}
    for r in p:
        total[r["key"] >> toxicity.BITS] = total.get(r["key"] >> toxicity.BITS, 0) + r["p"]
    assert chars and all(0 < v <= 1 + 1e-9 for v in total.values())


def test_rates_meet_the_targets(spark):
    rnd = np.random.default_rng(6)
    p = rnd.dirichlet([2, .3, .3], size=500)
    n = rnd.integers(1, 900, 500)
    df = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, p, strict=True)], "n_tokens long, p array<double>")
    have = (n[:, None] * p).sum(axis=0)
    want = have * [1.0, 0.6, 0.5]
    rate = mixing.rates_of(p, mixing.fit_rates(df, want))[0]
    assert rate.min() >= 0 and np.abs((rate * n) @ p - want).max() < 1e-4 * n.sum()


def test_mixing_edges(spark):
    rows = [(i, ("good plain words here " * 5) if i % 3 else ("### $$$ %%% junk " * 5)) for i in range(120)]
    rows += [(900, None), (901, ""), (None, "x"), (5, rows[5][1])]
    lab = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(120)] + [(None, 1, 1), (900, None, None)],
                                "doc_id long, quality int, toxic int")
    got = mixing.mix(docs_of(spark, rows), lab, {"good": 0.9, "low_quality": 0.1}).collect()
    assert len(got) == len(rows) and all(r["rate"] >= 0 and r["copies"] >= 0 for r in got)
    tokens = {d: sum(r["rate"] * r["n_tokens"] * r[f"p_{d}"] for r in got) for d in mixing.DOMAINS}
    assert abs(tokens["good"] / (tokens["good"] + tokens["low_quality"]) - 0.9) < 0.01
    assert len({(r["rate"], r["copies"]) for r in got if r["doc_id"] == 5}) == 1
    with pytest.raises(ValueError):
        mixing.mix(docs_of(spark, rows), lab, {"good": -1.0})
    assert mixing.mix(docs_of(spark, []), lab).count() == 0


def mixture(spark, kinds, label_of):
    """Documents and labels for domains repeated as in ``kinds``."""
    words = {"good": "river stone house tree green", "low": "### $$$ %%% junk @@@", "toxic": "grobian grobulu groxxen vile scum"}
    rnd = random.Random(8)
    rows = [(i, " ".join(rnd.choice(words[k].split()) for _ in range(20))) for i, k in enumerate(kinds)]
    lab = spark.createDataFrame([(i, *label_of[k]) for i, k in enumerate(kinds) if k in label_of],
                                "doc_id long, quality int, toxic int")
    return docs_of(spark, rows), lab


@pytest.mark.parametrize("n_toxic, labelled", [(0, "good low toxic"), (10, "good low"), (10, "good low toxic"),
                                               (10, "good"), (10, "")])
def test_mixing_keeps_the_good_documents_when_a_domain_is_scarce(spark, n_toxic, labelled):
    """No toxic labels or texts; 0.5 % toxic; one labelled domain; no label."""
    label_of = {k: v for k, v in {"good": (1, 0), "low": (0, 0), "toxic": (0, 1)}.items() if k in labelled.split()}
    kinds = ["toxic" if i % 200 == 0 and n_toxic else "low" if i % 8 == 1 else "good" for i in range(2000)]
    got = {r["doc_id"]: r["copies"] for r in mixing.mix(*mixture(spark, kinds, label_of)).collect()}
    copies, size = ({k: sum(got[i] if c else 1 for i, x in enumerate(kinds) if x == k) for k in set(kinds)} for c in (1, 0))
    assert copies["good"] > 0.97 * size["good"]
    if "low" in label_of:  # weights 0.88 and 0.08
        assert abs(copies["low"] / copies["good"] - 0.08 / 0.88) < 0.03
    if "toxic" in label_of and n_toxic:
        assert 0 < copies["toxic"] <= 1.5 * size["toxic"]
    with pytest.raises(ValueError):
        mixing.targets_of(np.array([5.0, 1.0, 0.0]), np.array([0.0, 0.0, 1.0]), None, False)
