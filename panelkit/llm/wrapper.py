"""HTML extraction by wrapper induction: the DOM trees of a host's pages are
aligned by simple tree matching; what stays the same is template, what varies is content."""

from __future__ import annotations

import hashlib
import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.config import cut_lineage
from panelkit.llm.common import kept, lookup, map_arrow, table

# A slot is template if this share of at least MIN_ARTICLES different articles of
# the host have the same text there, or if links hold LINK_SHARE of its characters.
SAME_SHARE, MIN_ARTICLES, LINK_SHARE = 0.8, 3, 0.5
# So many (host, tree) rows of template slots, and slots in all, are broadcast; more are joined.
BROADCAST_ROWS, BROADCAST_SLOTS = 100_000, 1_000_000
# Elements nested deeper belong to the ancestor at this depth.
DEPTH = 128
# Tree shapes a worker remembers.
MEMO = 20_000

# Elements and names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var".split())
UNSEEN = frozenset("html body".split())
REPEATED = frozenset("p li h1 h2 h3 h4 h5 h6 dt dd tr td th blockquote pre figcaption option".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table "
                   "ul".split())
ENDS_SELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
HOLDS = frozenset("ul ol menu dl table select article main section div body".split())
BOILERPLATE_TAGS = frozenset("head nav footer aside form button select dialog noscript template script style "
                             "textarea title iframe object svg math canvas audio video menu noembed noframes xmp "
                             "datalist label legend fieldset option".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog form menu menubar "
                              "toolbar status".split())
BOILERPLATE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adsense adbox adslot banner sponsor
sponsored promo promotion promoted sidebar menu menubar nav navbar navigation breadcrumb breadcrumbs masthead topbar
footer cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup
login signin share sharing social related recommended recommendations trending widget comment comments commentlist
respond reply replies disqus discussion pagination pager toolbar copyright disclaimer""".split())
TOP_WORDS = frozenset("header head".split())  # template unless inside the article
NEGATED = frozenset("has no with without open closed enabled disabled is".split())
ARTICLE_TAGS = frozenset("article main".split())
ARTICLE_WORDS = frozenset("article articlebody post entry story content main".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
NAMES = re.compile(r"\b(class|id|role|itemprop)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))", re.I)
UNSAFE = re.compile(r"[^\w.#:@-]+")


def host_of(url: str | None) -> str:
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*+://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m.group(1).lower() if m else ""


class Node:
    __slots__ = ("label", "kids", "parent", "depth", "shape", "text")

    def __init__(self, label: str, parent: Node | None):
        self.label, self.parent, self.kids, self.text = label, parent, [], False
        self.depth = parent.depth + 1 if parent else 0
        if parent:
            parent.kids.append(self)


def _label(tag: str, attributes: str) -> str:
    """tag.class...#id@role with digits as 0."""
    if "=" not in attributes:
        return tag
    named = {k.lower(): (a or b or c) for k, a, b, c in NAMES.findall(attributes)}
    parts = [tag, *[f".{c}" for c in sorted(set(named.get("class", "").lower().split()))]]
    parts += [f"#{named['id'].lower()}"] if named.get("id") else []
    parts += [f"@{named[k].lower()}" for k in ("role", "itemprop") if named.get(k)]
    return UNSAFE.sub("_", re.sub(r"[0-9]+", "0", "".join(parts)))


def _words(label: str) -> tuple[str, set[str], set[str]]:
    """(tag, words of classes and id, roles) of a label."""
    tag, *names = re.split(r"(?=[.#@])", label)
    words, roles = set(), set()
    for n in names:
        if n[0] == "@":
            roles.add(n[1:])
            continue
        split = set(re.split(r"[^a-z]+", n[1:]))
        if not split & NEGATED:
            words |= split
    return tag, words, roles


def parse(text: str) -> tuple[Node, list[tuple[Node | None, str, bool]]]:
    """(root, pieces): the tree of block elements and the texts in page order, each
    with its node and whether it stands in a link; node None is a block's edge."""
    root = Node("", None)
    stack: list[tuple[str, Node]] = [("", root)]
    pieces: list[tuple[Node | None, str, bool]] = []
    links, at, end = 0, 0, len(text)

    def say(piece: str) -> None:
        if piece:
            pieces.append((stack[-1][1], references.unescape(piece) if "&" in piece else piece, links > 0))

    while at < end:
        m = TOKEN.search(text, at)
        if not m:
            say(text[at:])
            break
        say(text[at:m.start()])
        at = m.end()
        tag = m.group(2) or m.group(5)
        if not tag:
            continue
        tag, closing, attributes = tag.lower(), m.group(1) or m.group(4), m.group(3) or m.group(6) or ""
        if tag in UNSEEN:
            continue
        if tag == "a":
            links = 0 if closing else 1
        if closing:
            where = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            if where:
                if tag not in INLINE:
                    pieces.append((None, " ", False))
                    links = 0
                del stack[where:]
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                pieces.append((None, " ", False))
            continue
        label = _label(tag, attributes)
        if tag in INLINE:
            if label != tag and boilerplate(label, True):
                stack.append((tag, _node(label, stack[-1][1])))
            elif any(s[0] == tag for s in stack[1:]):
                stack.append((tag, stack[-1][1]))  # so that its end does not close the marked one
            continue
        pieces.append((None, " ", False))
        if tag in ENDS_P:
            _close(stack, {"p"})
        if tag in ENDS_SELF:
            _close(stack, ENDS_SELF[tag])
        if attributes.endswith("/") and tag in ("svg", "math"):
            continue
        stack.append((tag, _node(label, stack[-1][1])))
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(text, at)
            at = close.start() if close else end
    return root, pieces


def _close(stack: list[tuple[str, Node]], tags: set[str]) -> None:
    """Ends the innermost open one of ``tags``, unless a list, table or section is in between."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i][0] in tags:
            del stack[i:]
            return
        if stack[i][0] in HOLDS:
            return


def _node(label: str, parent: Node) -> Node:
    return parent if parent.depth >= DEPTH else Node(label, parent)


def boilerplate(label: str, inside: bool) -> bool:
    """Do the names of an element say that it is not main text? ``inside``: it is in the article."""
    tag, words, roles = _words(label)
    if tag in ARTICLE_TAGS:
        return bool(words & {"comment", "reply", "advert", "sponsored", "teaser"}) and inside
    return (tag in BOILERPLATE_TAGS or bool(roles & BOILERPLATE_ROLES) or bool(words & BOILERPLATE_WORDS)
            or (not inside and (tag == "header" or bool(words & TOP_WORDS))))


def collapse(root: Node) -> tuple[str, dict[Node, int]]:
    """(shape, slot of each node): siblings that repeat a text element, or the
    shape of the sibling before, are one slot. Slots are numbered in preorder."""
    class Slot:
        __slots__ = ("label", "kids", "nodes", "shape")

        def __init__(self, label, kids, nodes):
            self.label, self.kids, self.nodes = label, kids, nodes
            self.shape = label + ("(" + ",".join(k.shape for k in kids) + ")" if kids else "")

    def join(a: Slot, b: Slot) -> Slot:
        if a.shape == b.shape:
            kids = [join(x, y) for x, y in zip(a.kids, b.kids, strict=True)]
        else:
            kids = grouped([*a.kids, *b.kids], True)
        return Slot(a.label, kids, a.nodes + b.nodes)

    def grouped(slots: list[Slot], all_of_a_label: bool = False) -> list[Slot]:
        out: list[Slot] = []
        place: dict[str, int] = {}
        for s in slots:
            i = place.get(s.label)
            if i is not None and (all_of_a_label or s.label.split(".")[0].split("#")[0].split("@")[0] in REPEATED):
                out[i] = join(out[i], s)
            elif out and out[-1].shape == s.shape:
                out[-1] = join(out[-1], s)
            else:
                place.setdefault(s.label, len(out))
                out.append(s)
        return out

    def build(node: Node) -> Slot:
        return Slot(node.label, grouped([build(k) for k in node.kids]), [node])

    top, slots = build(root), {}
    def number(s: Slot) -> None:
        at = number.n
        number.n += 1
        for node in s.nodes:
            slots[node] = at
        for k in s.kids:
            number(k)
    number.n = 0
    number(top)
    return top.shape, slots


def tree_of(shape: str) -> list[tuple[str, int, list[int]]]:
    """(label, parent, children) of every slot of a shape, in preorder."""
    nodes: list[tuple[str, int, list[int]]] = [(re.match(r"[^(),]*", shape).group(), -1, [])]
    at, i = 0, len(nodes[0][0])
    for mark, label in re.findall(r"([(),])([^(),]*)", shape[i:]):
        if mark == "(":
            parent = at
        elif mark == ",":
            parent = nodes[at][1]
        else:
            at = nodes[at][1]
            continue
        nodes.append((label, parent, []))
        at = len(nodes) - 1
        nodes[parent][2].append(at)
    return nodes


def simple_tree_matching(a: list, b: list) -> list[int]:
    """Slot of ``b`` for each slot of ``a`` (-1: none) in a maximum matching that
    keeps labels, parents and the order of siblings."""
    weight: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}

    def match(i: int, j: int) -> int:
        if a[i][0] != b[j][0]:
            return 0
        if (i, j) in weight:
            return weight[i, j][0]
        x, y = a[i][2], b[j][2]
        m = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        w = [[match(p, q) for q in y] for p in x]
        for p in range(len(x)):
            for q in range(len(y)):
                m[p + 1][q + 1] = max(m[p][q + 1], m[p + 1][q], m[p][q] + w[p][q])
        pairs, p, q = [], len(x), len(y)
        while p and q:
            if w[p - 1][q - 1] and m[p][q] == m[p - 1][q - 1] + w[p - 1][q - 1]:
                p, q = p - 1, q - 1
                pairs.append((x[p], y[q]))
            elif m[p][q] == m[p - 1][q]:
                p -= 1
            else:
                q -= 1
        weight[i, j] = (m[-1][-1] + 1, pairs)
        return weight[i, j][0]

    out = [-1] * len(a)
    todo = [(0, 0)] if match(0, 0) else []
    while todo:
        i, j = todo.pop()
        out[i] = j
        todo += weight[i, j][1]
    return out


def readable(shape: str) -> list[int]:
    """Of every slot: 0 named as something else than main text, 1 other text, 2 in
    an element named as the article's, 3 in an article or main element."""
    out: list[int] = []
    for label, parent, _ in tree_of(shape):
        above = out[parent] if parent >= 0 else 1
        tag, words, roles = _words(label)
        if not above or (label and boilerplate(label, above > 1)):
            out.append(0)
        elif tag in ARTICLE_TAGS or "main" in roles or "articlebody" in roles:
            out.append(3)
        elif words & ARTICLE_WORDS:
            out.append(max(above, 2))
        else:
            out.append(above)
    return out


def _remember(own: dict, key: str, make) -> object:
    if key not in own:
        if len(own) >= MEMO:
            own.clear()
        own[key] = make()
    return own[key]


def _hash(text: str, size: int = 8) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=size).digest()


def _page(text: str) -> tuple[str, str, list, dict]:
    root, pieces = parse(text)
    shape, slots = collapse(root)
    return shape, _hash(shape, 16).hex(), pieces, slots


def page_slots(text: str) -> tuple[str, str, str, dict[int, tuple[int, int, int]]]:
    """(shape, its key, digest of the article, slot -> (text hash, characters, of them in links))."""
    shape, key, pieces, slots = _page(text)
    texts: dict[int, list[str]] = {}
    chars: dict[int, list[int]] = {}
    for node, piece, link in pieces:
        if node is None or not piece.strip():
            continue
        s = slots[node]
        texts.setdefault(s, []).append(piece)
        c = chars.setdefault(s, [0, 0])
        c[0] += len(piece)
        c[1] += len(piece) * link
    read = _remember(kept("wrapper").setdefault("read", {}), shape, lambda: readable(shape))
    whole = {s: " ".join("".join(t).split()) for s, t in texts.items()}
    body = max((s for s in whole if read[s]), key=lambda s: (read[s], len(whole[s]), -s), default=None)
    sig = _hash(whole[body] if body is not None else "", 16).hex()
    return shape, key, sig, {s: (int.from_bytes(_hash(t), "big", signed=True), *chars[s]) for s, t in whole.items()}


def main_text(text: str, template: set[int] | frozenset, page=None) -> str:
    """The main text of a page whose ``template`` slots are known."""
    shape, _, pieces, slots = page or _page(text)
    read = _remember(kept("wrapper").setdefault("read", {}), shape, lambda: readable(shape))
    level = max((read[slots[n]] for n, t, _ in pieces if n is not None and t.strip()), default=0)
    if not level:
        return ""
    # text beside the article counts only where a page marks no article
    parts = [t if n is None or (read[slots[n]] == level and slots[n] not in template) else ""
             for n, t, _ in pieces]
    return " ".join("".join(parts).split())


PAGE = "host string, tree string, shape string, sig string, slots array<int>, hashes array<bigint>, " \
       "chars array<bigint>, links array<bigint>"


def _read_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[tuple[str, str]] = set()
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            host = host_of(batch.column("url")[i].as_py())
            shape, tree, sig, found = page_slots(batch.column("html")[i].as_py() or "")
            new = (host, tree) not in seen
            if new and len(seen) < MEMO:
                seen.add((host, tree))
            order = sorted(found)
            rows.append((host, tree, shape if new else None, sig, order, *[[found[s][k] for s in order] for k in range(3)]))
        if rows:
            cols = list(zip(*rows, strict=True))
            kinds = [pa.string()] * 4 + [pa.list_(pa.int32())] + [pa.list_(pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                             [f.split()[0] for f in PAGE.split(", ")])


def _match_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every tree of a host aligned with the host's pivot tree."""
    for batch in batches:
        for r in batch.to_pylist():
            a = tree_of(r["shape"])
            to = simple_tree_matching(a, tree_of(r["pivot"]))
            n = len(to)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["host"]] * n), pa.array([r["tree"]] * n), pa.array(range(n), pa.int32()),
                 pa.array([f"{j}" if j >= 0 else f"{r['tree']}/{i}" for i, j in enumerate(to)])],
                ["host", "tree", "slot", "place"])


def induce(pages: DataFrame) -> DataFrame:
    """(host, tree, template, n): the template slots of every tree of every host.

    All pages count; pages of a host with the same article count once, so copies
    of one article do not look like a template. The pivot is the host's most
    frequent tree; the others are aligned with it once each."""
    spark = pages.sparkSession
    read = cut_lineage(map_arrow(pages.select("url", "html"), _read_task, PAGE, "wrapper"))
    trees = cut_lineage(read.groupBy("host", "tree").agg(F.max("shape").alias("shape"), F.count(F.lit(1)).alias("n")))
    total = trees.count()
    pivots = trees.groupBy("host").agg(F.max_by("shape", F.struct("n", "tree")).alias("pivot"),
                                       F.count(F.lit(1)).alias("trees"))
    places = cut_lineage(map_arrow(lookup(trees, pivots, ["host"], "trees", total).select("host", "tree", "shape", "pivot"),
                                   _match_task, "host string, tree string, slot int, place string", "wrapper"))
    one = read.groupBy("host", "sig").agg(F.min(F.struct("tree", "slots", "hashes", "chars", "links")).alias("p"))
    facts = one.select("host", "p.tree", F.explode(F.arrays_zip("p.slots", "p.hashes", "p.chars", "p.links")).alias("x")) \
        .select("host", "tree", F.col("x.slots").alias("slot"), F.col("x.hashes").alias("h"),
                F.col("x.chars").alias("chars"), F.col("x.links").alias("links"))
    # add up by tree and slot before the places are looked up
    facts = cut_lineage(facts.groupBy("host", "tree", "slot", "h").agg(
        F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.sum("links").alias("links")))
    sizes = facts.groupBy("host", "tree", "slot").agg(F.count(F.lit(1)).alias("rows"))
    known = places.join(sizes, ["host", "tree", "slot"])
    placed = lookup(facts, known, ["host", "tree", "slot"], "rows", facts.count())
    texts = placed.groupBy("host", "place", "h").agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"),
                                                     F.sum("links").alias("links"))
    verdicts = texts.groupBy("host", "place").agg(
        F.max("n").alias("top"), F.sum("n").alias("all"), F.sum("chars").alias("chars"), F.sum("links").alias("links"))
    same = (F.col("all") >= MIN_ARTICLES) & (F.col("top") >= SAME_SHARE * F.col("all"))
    fixed = verdicts.filter(same | (F.col("links") >= LINK_SHARE * F.col("chars"))).select("host", "place")
    found = places.join(fixed, ["host", "place"], "left_semi").groupBy("host", "tree").agg(
        F.sort_array(F.collect_list("slot")).alias("template"))
    return cut_lineage(found.join(trees.select("host", "tree", "n"), ["host", "tree"]))


def extract_pages(pages: DataFrame, id_col: str = "page_id", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per row of ``pages(page_id, url, html)``: page_id, url, text, n_chars.

    Null and empty html give an empty text. Pages without a host (null or other
    urls) are one host of their own. A page's text is that of the slots that
    vary on its host, that are not mostly links, and whose element or ancestors
    are not named as menu, header, footer, sidebar, notice, advert, form or
    comments; where a page marks its article, text beside it does not count.
    Character references are decoded; white space inside a block is one space.
    Elements nested deeper than DEPTH belong to the ancestor there. Repeated
    rows stay as often as they come. Empty table: empty result. Other columns
    are not read.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).alias("page"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    templates = induce(rows)
    size = templates.agg(F.count(F.lit(1)), F.sum(F.size("template"))).first()
    kind = rows.schema["page"].dataType.simpleString()
    out = f"page {kind}, url string, text string, n_chars bigint"

    def written(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("page"), batch.column("url"), pa.array(texts, pa.string()),
                                           pa.array([len(t) for t in texts], pa.int64())],
                                          ["page", "url", "text", "n_chars"])

    if size[0] <= broadcast_rows and (size[1] or 0) <= BROADCAST_SLOTS:
        shared = spark.sparkContext.broadcast(
            {(r["host"], r["tree"]): frozenset(r["template"]) for r in templates.collect()})

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = []
                for i in range(batch.num_rows):
                    page = _page(batch.column("html")[i].as_py() or "")
                    key = (host_of(batch.column("url")[i].as_py()), page[1])
                    texts.append(main_text("", shared.value.get(key, frozenset()), page))
                yield written(batch, texts)
        found = map_arrow(rows, near, out, "wrapper")
    else:
        def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hosts = [host_of(u) for u in batch.column("url").to_pylist()]
                trees = [_page(batch.column("html")[i].as_py() or "")[1] for i in range(batch.num_rows)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hosts, pa.string()), pa.array(trees, pa.string())],
                                                 [*batch.schema.names, "host", "tree"])

        def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield written(batch, [main_text(batch.column("html")[i].as_py() or "",
                                                frozenset(batch.column("template")[i].as_py() or ()))
                                      for i in range(batch.num_rows)])
        wide = map_arrow(rows, keyed, f"page {kind}, url string, html string, host string, tree string", "wrapper")
        total = templates.agg(F.sum("n")).first()[0] or 0
        found = map_arrow(lookup(wide, templates, ["host", "tree"], "n", total), far, out, "wrapper")
    return found.select(F.col("page").alias(id_col), "url", "text", "n_chars")


def op11(spark, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
