"""HTML extraction, conversation repair and tokenizer alignment against brute force."""

import collections
import hashlib
import html
import random
import re
import zlib

import numpy as np
import pytest

from conftest import SF_SMALL
from panelkit.llm import alignment, queries, repair, wrapper

TOK = pytest.importorskip("public_tokenizers")


def table(spark, name):
    return spark.read.parquet(f"{SF_SMALL}/{name}.parquet")


# --- HTML extraction ------------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string"


def article_of(page):
    """The text of the one <article> of the test tables' pages."""
    m = re.search(r"<article>(.*?)</article>", page, re.S)
    return " ".join(html.unescape(re.sub(r"</?(?:p|h1|br)>", " ", re.sub(r"</?b>", "", m.group(1)))).split())


def test_pages_give_their_article(spark):
    got = {r["page_id"]: r for r in queries.queries()["op11_html_extraction"](spark, SF_SMALL).collect()}
    pages = table(spark, "pages").collect()
    assert len(got) == len(pages)
    for p in pages:
        want = article_of(p["html"])
        assert (got[p["page_id"]]["text"], got[p["page_id"]]["n_chars"]) == (want, len(want))


def other_layout(rnd, i):
    def words(n):
        return " ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(n))
    title, paras = words(4), [words(12) for _ in range(rnd.randint(1, 5))]
    menu = "".join(f'<li><a href="/{j}">{words(1)}</a></li>' for j in range(4))
    said = "".join(f"<li>{words(5)}</li>" for _ in range(rnd.randint(0, 3)))
    page = (f'<html><body class="single with-sidebar"><header><h1>Site</h1>{words(2)}</header><ul class=menu>{menu}</ul>'
            f'<div id=wrap><div class="cookie-notice">Cookies {words(1)}</div><div class="post">'
            f'<div class="meta">Filed under: News</div><h2>{title}</h2>' + "".join(f"<p>{p}" for p in paras)
            + f'<div class="line">Thanks for reading.</div></div><div class=sidebar><p>{words(9)}</p></div>'
            f'<section id="comments"><ol>{said}</ol></section><form><label>Find</label></form></div>'
            f'<div class="footer">(c) {words(3)}</div></body></html>')
    return (i, f"https://site.example/{i}", page), " ".join([title, *paras])


@pytest.mark.parametrize("broadcast_rows", [wrapper.BROADCAST_ROWS, -1])
def test_constant_nodes_are_template(spark, broadcast_rows):
    """Lines that all pages of a host share go, wherever they stand; a host of
    copies of one article keeps it."""
    rnd = random.Random(1)
    made = [other_layout(rnd, i) for i in range(12)]
    copies = [(100 + i, "http://copies.example/", made[0][0][2]) for i in range(6)]
    out = {r["page_id"]: r["text"] for r in wrapper.extract_pages(
        spark.createDataFrame([m[0] for m in made] + copies, PAGES), broadcast_rows=broadcast_rows).collect()}
    assert [out[i] for i in range(12)] == [m[1] for m in made]
    assert out[100] == "Filed under: News " + made[0][1] + " Thanks for reading."


def best_matching(a, b, i=0, j=0):
    """Simple tree matching by trying every order-keeping set of pairs of children."""
    if a[i][0] != b[j][0]:
        return 0
    def rest(x, y):
        if not x or not y:
            return 0
        return max(rest(x[1:], y), *[best_matching(a, b, x[0], y[k]) + rest(x[1:], y[k + 1:]) for k in range(len(y))])
    return 1 + rest(a[i][2], b[j][2])


def test_simple_tree_matching_is_largest():
    rnd = random.Random(2)
    def shape(depth):
        kids = [shape(depth - 1) for _ in range(rnd.randint(0, 3))] if depth else []
        return rnd.choice("ab") + ("(" + ",".join(kids) + ")" if kids else "")
    for _ in range(200):
        x, y = wrapper.tree_of("r(" + shape(2) + "," + shape(2) + ")"), wrapper.tree_of("r(" + shape(2) + ")")
        to = wrapper.simple_tree_matching(x, y)
        assert sum(j >= 0 for j in to) == best_matching(x, y)
        for i, j in enumerate(to):
            if j >= 0:
                assert x[i][0] == y[j][0] and (x[i][1] < 0 or to[x[i][1]] == y[j][1])


def test_pages_edges(spark):
    long = "<p>" + "word &amp; " * 200_000 + "</p>"
    rows = [(1, None, None), (2, "x", ""), (3, "http://a/", "just text &amp; more&nbsp;x"),
            (3, "http://a/", "<p>a<p>b<b>c</b>d<br>e<script>x</script"), (None, "http://b", "<div" * 300 + "<p>" * 300 + "deep"
             + "<div>" * 3000 + "z"), (5, "http://c", '<a title="x > y">k</a> <p class="ad">no</p><!-- c > --> z <unclosed "'),
            (6, "http://d", long), (6, "http://d", long)]
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' AS host", "'y' AS text", "1 AS tree", "2 AS n")
    out = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in wrapper.extract_pages(df).collect()), key=str)
    big = ("word & " * 200_000).strip()
    assert out == sorted([(1, "", 0), (2, "", 0), (3, "just text & more x", 18), (3, "a bcd e", 7), (None, "deep z", 6),
                          (5, "k z", 3), (6, big, len(big)), (6, big, len(big))], key=str)
    assert wrapper.extract_pages(df.limit(0)).collect() == []


# --- conversation repair --------------------------------------------------------------------------------------

def cheapest(rows):
    """(cost, audit) by search over the states of the grammar; rows: (initial, forced, cut)."""
    def inserted(states):
        todo = list(states)
        while todo:
            s = todo.pop()
            t, v = 3 if s != 3 else 2, (states[s][0] + 3, states[s][1] + "I")
            if t not in states or v < states[t]:
                states[t] = v
                todo.append(t)
        return states
    states = inserted({0: (0, "")})
    for initial, forced, cut in rows:
        new = {}
        def put(t, c, a):
            if t not in new or (c, a) < new[t]:
                new[t] = (c, a)
        for s, (c, a) in states.items():
            put(s, c + 4, a + "D")
            if not forced:
                if initial == "s" and s == 0:
                    put(1, c + 3 * cut, a + "K")
                same = initial == ("a" if s == 3 else "u")
                put(2 if s == 3 else 3, c + 3 * cut + 3 * (not same), a + ("K" if same else "R"))
        states = inserted(new)
    return min(v for s, v in states.items() if s in (0, 2))


def enumerated(rows):
    """(cost, audit) from the definition: every string of edits."""
    best = [(10**9, "")]
    def go(i, roles, cost, audit, left):
        if cost > best[0][0]:
            return
        if i == len(rows):
            if re.fullmatch("(s?(ua)+)?", roles):
                best[0] = min(best[0], (cost, audit))
        for r in "ua" * (left > 0):
            go(i, roles + r, cost + 3, audit + "I", left - 1)
        if i < len(rows):
            initial, forced, cut = rows[i]
            go(i + 1, roles, cost + 4, audit + "D", left)
            if not forced:
                go(i + 1, roles + initial, cost + 3 * cut, audit + "K", left)
                for r in set("ua") - {initial}:
                    go(i + 1, roles + r, cost + 3 * cut + 3, audit + "R", left)
    go(0, "", 0, "", 3)
    return best[0]


def coded(s):
    return [("x" if c in "do" else c.lower(), c == "d", int(c.isupper())) for c in s]


def test_alignment_is_cheapest_and_least():
    rnd = random.Random(3)
    for _ in range(150):
        s = "".join(rnd.choice("dsSuUaAo") for _ in range(rnd.randint(0, 4)))
        assert repair.repair_rows(s) == cheapest(coded(s)) == enumerated(coded(s))
    for _ in range(1000):
        s = "".join(rnd.choice(rnd.choice(["ua", "dsSuUaAo"])) for _ in range(rnd.randint(0, 40)))
        blocks = repair.Repair(rnd.choice([3, 7, 512]))
        at = 0
        while at < len(s):
            size = rnd.randint(1, 9)
            blocks.add(s[at:at + size])
            at += size
        assert repair.repair_rows(s) == blocks.result() == cheapest(coded(s))
    s = "".join(rnd.choice("uauauauadsSUAo") for _ in range(6000))
    blocks = repair.Repair()
    blocks.add(s)
    assert blocks.result() == cheapest(coded(s))


def repaired(rows):
    """The contract's columns, row by row."""
    out = {}
    for own in {c[0] for c in rows}:
        kept = []
        for conv, turn, role, text in rows:
            if conv != own:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
            kept += [(turn, "user" if hit == 4 else role, text)] * {0: 0, 3: 2}.get(hit, 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        turns = {r[0] for r in kept if r[0] is not None}
        seen, faults, counts = set(), [], [0, 0, 0]
        for _, role, text in kept:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                counts[fault] += 1
            faults.append((role[:1], fault < 2, int(fault == 2)))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(faults, faults[1:], strict=False))
        cost, audit = cheapest(faults)
        lines, want, at = [], "user", iter(kept)
        for e in audit:
            role, text = ("", "") if e == "I" else next(at)[1:]
            if e == "D":
                continue
            lines.append((role if e == "K" else want) + ":" + text)
            if e != "K" or role[:1] != "s":
                want = "assistant" if want == "user" else "user"
        out[own] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


CONVERSATIONS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("block_rows", [4, repair.BLOCK_ROWS])
def test_repair_brute_force(spark, block_rows):
    rnd = random.Random(5)
    roles = ["user", "assistant", "user", "assistant", "system", None, "tool", ""]
    texts = ["Hi.", "Hello", "  ", "", None, "Yes!", "a?\n", "ok \t", "long " * 20_000]
    rows = [(c, rnd.choice([t, t, t, t + rnd.randint(0, 3), None]), rnd.choice(roles), rnd.choice(texts))
            for c in [*range(60), None] for t in range(rnd.randint(1, 9) if c is not None else 120)]
    rows += rows[:40] + [(900, None, None, None)] + [(901, 7, "user", "Same.")] * 30
    df = spark.createDataFrame(rows, CONVERSATIONS).selectExpr("*", "1 AS ck", "'x' AS h", "0 AS n", "'y' AS audit")
    got = {r[0]: tuple(r[1:]) for r in repair.repair_conversations(df, block_rows).collect()}
    assert got == repaired(rows)
    assert repair.repair_conversations(df.limit(0)).collect() == []


def test_repair_of_the_table(spark):
    got = {r[0]: tuple(r[1:]) for r in queries.queries()["op12_conversation_repair"](spark, SF_SMALL).collect()}
    assert got == repaired([tuple(r) for r in table(spark, "conversations").select("conv_id", "turn", "role", "text").collect()])


# --- cross-tokenizer alignment --------------------------------------------------------------------------------

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def models():
    return alignment.Tokenizers(TOK.path(A), TOK.path(B))


def aligned(models, texts):
    """The contract's columns from whole texts, pair by pair."""
    found = []
    for t in texts:
        a = models.a.encode(" " + (t or ""), add_special_tokens=False).ids
        b = models.b.encode(t or "")
        raw = (" " + (t or "")).encode()
        parts = [[models.bytes_a[i] for i in a], [models.bytes_b[i] for i in b]]
        if not t or b"".join(parts[0]) != raw or b"".join(parts[1]) != raw:
            found.append(None)
            continue
        spans = []
        for p in parts:
            ends = np.cumsum([len(x) for x in p]).tolist()
            spans.append(list(zip([0, *ends[:-1]], ends, strict=True)))
        links, first = [], 0
        for i, (s, e) in enumerate(spans[0]):
            while spans[1][first][1] <= s:
                first += 1
            for j in range(first, len(b)):
                if spans[1][j][0] >= e:
                    break
                links.append((a[i], b[j]))
        groups, i, j = [], 0, 0
        for cut in sorted({e for _, e in spans[0]} & {e for _, e in spans[1]}):
            p = next(k for k in range(i, len(a)) if spans[0][k][1] == cut) + 1
            q = next(k for k in range(j, len(b)) if spans[1][k][1] == cut) + 1
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            i, j = p, q
        found.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count = collections.Counter(x for f in found if f for x in f[3])
    top = collections.defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else
            (*f[:3], len(f[3]), sum(count[x] == top[x[1]] for x in f[3]), sum(count[x] for x in f[3]), f[4]) for f in found]


@pytest.mark.parametrize("limits", [{}, {"broadcast_pairs": 10}])
def test_alignment_brute_force(spark, models, limits):
    rnd = random.Random(5)
    bits = ["a", "b", " ", "  ", "\n", "\t", "é", "ß", "▁", "<|endoftext|>", "<s>", "<0x41>", "12", "3", ".", "'s", "漢字",
            "😀", "​", "\xa0", "　", "\x00", "\x1c", "\x85", "the ", "hello ", "᠎", "ﬁ", "\r\n", "﻿"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 30))) for _ in range(400)] + [None, "", " ", "\n", "b "]
    texts += texts[:100] + ["same text here"] * 50 + [("many words " * 3000).strip()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr(
        "*", "'k' AS key", "3 AS copies", "'x' AS pair")
    got = {r[0]: tuple(r[1:]) for r in alignment.align_tokenizers(df, TOK.path(A), TOK.path(B), **limits).collect()}
    assert [got[i] for i in range(len(texts))] == aligned(models, texts)
    assert alignment.align_tokenizers(df.limit(0), TOK.path(A), TOK.path(B)).collect() == []


def test_alignment_in_blocks_and_slices(spark, models, monkeypatch):
    """Long texts are cut into slices of whole words; identifiers may be null or repeat."""
    for size in (1, 5, 50):
        monkeypatch.setattr(alignment, "SLICE", size)
        for t in ("a b  c\n d", " x", "x ", "word " * 40, "nospace" * 30, "\t a \t b"):
            assert " " + " ".join(w for part in models.words(t) for w in part) == " " + t
    rows = [(None, "a b"), (None, "a b"), (1, "a b"), (1, None)]
    got = [tuple(r) for r in alignment.align_tokenizers(
        spark.createDataFrame(rows, "doc_id long, text string"), TOK.path(A), TOK.path(B)).collect()]
    assert sorted(x[0] is None for x in got) == [False, False, True, True]
    assert {x[6] for x in got if x[1]} == {6} and sorted(x[1] for x in got) == [0, 2, 2, 2]


def test_alignment_of_the_table(spark, models):
    rows = table(spark, "documents").select("doc_id", "text").collect()
    got = {r[0]: tuple(r[1:]) for r in queries.queries()["op13_tokenizer_alignment"](spark, SF_SMALL).collect()}
    assert [got[r["doc_id"]] for r in rows] == aligned(models, [r["text"] for r in rows])
