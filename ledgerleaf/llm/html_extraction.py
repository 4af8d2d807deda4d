"""Main text of web pages by boosted trees over DOM nodes.

A page is read into a tree of block elements; the running text between their
boundaries makes leaves of its own. Every node gets a probability of belonging
to the article, from its tag, the tokens of its class, id and role, its depth,
the density of text, links, sentences and tags below it, its place in the page
and among its siblings, and what its ancestors are called. Decoding is
hierarchical: where a node is dropped everything below it is, so the best
labelling is found from the leaves up, comparing "drop the whole subtree" with
"keep this node and take the best of each child". No kept text can stand below
a dropped ancestor, and no node is kept without kept text below it.

There are no labelled pages, so the trees are trained on pages that
``sample_page`` composes with a fixed seed, with and without telling tags and
class names. The number of such pages is ``TRAINING_PAGES``; the model is a
broadcast of fixed size. Pages are mapped without a shuffle.

Scripts, styles, templates, form controls and the head are no text whatever the
trees say; a control inside a paragraph does not divide it. Formulas, text in drawings and what stands in for objects and scripts
are running text like that of any inline tag.
Character references are decoded once, white space inside a block (a line break
too) becomes one space, blocks are joined by a line feed.

Defined cases: null, empty or textless html gives an empty text. Unclosed,
stray and crossed tags are repaired: a block start ends an open paragraph, a
list item or cell ends its elder, an end tag closes what is open inside it.
Text without any tags is the article. Every row gives a row, so ties and
repeated rows need no rule; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import html
import random
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerleaf.llm.mapping import map_texts
from ledgerleaf.llm.registry import query, table
from ledgerleaf.llm.trees import Boosted

TRAINING_PAGES = 300
LEAF = "#text"

#: A comment (``<!-->`` and ``<!--->`` are whole ones), a declaration, or a tag
#: with its attributes. Quotes count only at the start of a value; a value
#: without them ends at white space or ``>``. No part is read twice.
TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)"
    r"((?>[\s/]+|=?[^\s/>=]+(?>\s*=\s*(?>\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>\"'][^\s>]*)?)?|=)*+)>?",
    re.DOTALL,
)
NAMED = re.compile(r"(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
PIECES = re.compile(r"[a-z]+")
SENTENCE = re.compile(r"[.!?…:;,](?:\s|$)")

RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
SILENT = frozenset("head script style title textarea input iframe".split())
#: Silent with all they hold, but no boundary: the text around them runs on.
HUSHED = frozenset("template button select datalist label".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html head body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption pre"
    " blockquote figure figcaption nav header footer aside form fieldset address details summary center hgroup dialog menu hr".split()
)
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
WITHIN = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}

FOR_TEXT = frozenset("article content post entry main story text body page blog news single".split())
AGAINST = frozenset(
    "nav navbar navigation menu header masthead head top foot footer bottom side sidebar aside ad ads advert advertisement adsense promo"
    " promotion sponsor sponsored banner cookie cookies consent gdpr notice alert popup modal overlay comment comments discussion disqus reply"
    " replies share sharing social related recommended recommendation more subscribe newsletter signup login search breadcrumb breadcrumbs"
    " pagination pager widget toolbar legal copyright tags meta complementary contentinfo form".split()
)
TAGS = (
    LEAF, "html", "body", "article", "main", "section", "div", "p", "h1", "h2", "ul", "li", "table", "td", "pre", "blockquote", "figure", "nav",
    "header", "footer", "aside", "form", "details",
)
ABOVE = ("article", "main", "section", "nav", "header", "footer", "aside", "form", "ul", "table", "details", "blockquote")
SAME = {"ol": "ul", "dl": "ul", "dt": "li", "dd": "li", "menu": "ul", "h3": "h2", "h4": "h2", "h5": "h2", "h6": "h2", "th": "td", "fieldset": "form", "dialog": "aside"}


@dataclass
class Page:
    """Nodes in page order; a parent comes before its children."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    names: list[str] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    silent: list[bool] = field(default_factory=list)

    def add(self, tag: str, parent: int, names: str = "", text: str = "", linked: int = 0) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.names.append(names)
        self.text.append(text)
        self.linked.append(linked)
        self.silent.append(tag in SILENT or (parent >= 0 and self.silent[parent]))
        return len(self.tag) - 1


def parse(source: str) -> Page:
    """The page's tree, in time that grows with the source alone: where an open
    tag stands is kept by tag, and nothing walks the stack."""
    page = Page()
    page.add("html", -1)
    stack = [0]
    places: dict[str, list[int]] = {}  # of each open tag in the stack, but the top's
    hush: list[str] = []  # open silent inline tags, the outer first
    within_hush: Counter[str] = Counter()  # blocks opened inside them
    hushed_at = firm = 0  # size of the stack where the outer one opened; how many are no labels
    run: list[str] = []
    links = linked = 0

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text and not page.silent[stack[-1]]:
                page.add(LEAF, stack[-1], text=text, linked=min(linked, len(text)))
            run.clear()
        linked = 0

    def last(tags: frozenset | set) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def cut(depth: int) -> None:
        nonlocal firm
        flush()
        while len(stack) > depth:
            places[page.tag[stack.pop()]].pop()
        if hush and len(stack) < hushed_at:
            hush.clear()
            within_hush.clear()
            firm = 0

    def close(tags: frozenset | set, within: set) -> None:
        depth = last(tags)
        if depth > last(within):
            cut(depth)

    at = 0
    while at < len(source):
        found = TOKEN.search(source, at)
        if not found:
            break
        if found.start() > at and not hush:
            run.append(source[at : found.start()])
            if links:
                linked += found.start() - at
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if found[1]:
            if tag in HUSHED:
                if tag in hush:
                    ended = ""
                    while ended != tag:
                        ended = hush.pop()
                        firm -= ended != "label"
                    if not hush:
                        within_hush.clear()
            elif hush and within_hush[tag]:
                within_hush[tag] -= 1
            elif tag == "a":
                links = max(0, links - 1)
            elif tag in BLOCK:
                depth = last({tag})
                if depth:
                    cut(depth)
                    links = 0
                elif not hush:
                    flush()
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.IGNORECASE).search(source, at)
            stop = source.find(">", end.end()) + 1 if end else 0
            at = stop if stop else len(source)
            continue
        if tag in HUSHED:
            if not hush:
                hushed_at = len(stack)
            # A form control inside another is that one's text.
            hush.append(tag)
            firm += tag != "label"
            continue
        if hush and not firm and tag in BLOCK:
            # What ends a paragraph, an item or a cell ends a label left open in it.
            close({"p"}, {"td", "th", "table"})
            close(CLOSES.get(tag, set()), WITHIN.get(tag, set()))
        if hush:
            if tag in BLOCK and tag not in VOID:
                within_hush[tag] += 1
        elif tag == "br":
            run.append(" ")
        elif tag == "a":
            links += 1
        elif tag in BLOCK and tag != "html":
            flush()
            close({"p"}, {"td", "th", "table"})
            if tag in CLOSES:
                close(CLOSES[tag], WITHIN[tag])
            if tag == "body":
                close({"head"}, set())
            names = " ".join(a or b or c for a, b, c in NAMED.findall(found[3])) if "=" in found[3] else ""
            node = page.add(tag, stack[-1], names.lower())
            if tag not in VOID and not found[3].endswith("/"):
                places.setdefault(tag, []).append(len(stack))
                stack.append(node)
                links = 0
    if at < len(source) and not hush:
        run.append(source[at:])
    flush()
    return page


def node_features(page: Page) -> np.ndarray:
    """One row of numbers for each node."""
    n = len(page.tag)
    parent = page.parent
    chars = [len(t) for t in page.text]
    marks = [len(SENTENCE.findall(t)) for t in page.text]
    words = [t.count(" ") + 1 if t else 0 for t in page.text]
    links = page.linked[:]
    tags = [int(t != LEAF) for t in page.tag]
    leaves = [int(t == LEAF) for t in page.tag]
    paragraphs = [int(t == "p") for t in page.tag]
    before, seen = [0] * n, 0
    for i in range(n):
        before[i] = seen
        seen += chars[i]
    total = max(1, seen)
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(1, n):
        children[parent[i]].append(i)
    sums = (chars, marks, words, links, tags, leaves, paragraphs)
    for i in range(n - 1, 0, -1):
        for s in sums:
            s[parent[i]] += s[i]
    good, bad, depth = [0] * n, [0] * n, [0] * n
    good_above, bad_above = [0] * n, [0] * n
    above = np.zeros((n, len(ABOVE)))
    rank = {tag: k for k, tag in enumerate(ABOVE)}
    place, fellows, alike, elder, younger = [0.0] * n, [1] * n, [1.0] * n, [0] * n, [0] * n
    for i in range(n):
        if page.names[i]:
            tokens = set(PIECES.findall(page.names[i]))
            good[i], bad[i] = len(tokens & FOR_TEXT), len(tokens & AGAINST)
        if i:
            p = parent[i]
            depth[i] = depth[p] + 1
            good_above[i], bad_above[i] = good_above[p] + good[p], bad_above[p] + bad[p]
            above[i] = above[p]
            tag = SAME.get(page.tag[p], page.tag[p])
            if tag in rank:
                above[i, rank[tag]] = 1
        mine = children[i]
        same = Counter(page.tag[c] for c in mine)
        for k, c in enumerate(mine):
            place[c] = k / max(1, len(mine) - 1)
            fellows[c] = len(mine)
            alike[c] = same[page.tag[c]] / len(mine)
            elder[c] = chars[mine[k - 1]] if k else 0
            younger[c] = chars[mine[k + 1]] if k + 1 < len(mine) else 0
    kinds = np.zeros((n, len(TAGS)))
    number = {tag: k for k, tag in enumerate(TAGS)}
    for i, tag in enumerate(page.tag):
        k = number.get(SAME.get(tag, tag))
        if k is not None:
            kinds[i, k] = 1
    a = {k: np.array(v, float) for k, v in zip(("chars", "marks", "words", "links", "tags", "leaves", "paragraphs"), sums, strict=True)}
    up = np.maximum(np.array(parent), 0)
    safe = np.maximum(a["chars"], 1)
    density = a["links"] / safe
    rows = [
        np.log1p(a["chars"]),
        a["chars"] / total,
        density,
        density[up],
        a["marks"] / np.maximum(a["words"], 1),
        a["words"] / np.maximum(a["leaves"], 1),
        np.log1p(a["chars"] / np.maximum(a["tags"], 1)),
        np.log1p(a["paragraphs"]),
        np.log1p(a["leaves"]),
        a["chars"] / np.maximum(a["chars"][up], 1),
        np.array(before) / total,
        np.array(depth, float),
        np.array(place),
        np.log1p(np.array(fellows, float)),
        np.array(alike),
        np.log1p(np.array(elder, float)),
        np.log1p(np.array(younger, float)),
        np.array(good, float),
        np.array(bad, float),
        np.array(good_above, float),
        np.array(bad_above, float),
        np.array([float("©" in t or "(c)" in t.lower()) for t in page.text]),
    ]
    return np.column_stack([*rows, kinds, above])


def decode(page: Page, probability: np.ndarray) -> list[bool]:
    """The likeliest labelling in which nothing is kept below a dropped node."""
    p = np.clip(probability, 1e-4, 1 - 1e-4)
    yes, no = np.log(p).tolist(), np.log(1 - p).tolist()
    n = len(page.tag)
    gains = [0.0] * n  # of the children that gain by being kept
    nearest, nearest_gain = [-1] * n, [-np.inf] * n  # the child that gains most
    gain = [-np.inf] * n  # of keeping a node over dropping its subtree
    for i in range(n - 1, -1, -1):
        if page.tag[i] == LEAF:
            gain[i] = -np.inf if page.silent[i] else yes[i] - no[i]
        elif nearest[i] >= 0:
            # A kept node holds kept text: at least the child that costs least.
            gain[i] = yes[i] - no[i] + (gains[i] if nearest_gain[i] > 0 else nearest_gain[i])
        if i and gain[i] > -np.inf:
            up = page.parent[i]
            gains[up] += max(gain[i], 0.0)
            if gain[i] >= nearest_gain[up]:
                nearest[up], nearest_gain[up] = i, gain[i]
    kept = [False] * n
    for i in range(n):
        if i == 0:
            kept[i] = gain[i] > 0
        elif kept[page.parent[i]]:
            kept[i] = gain[i] > 0 or nearest[page.parent[i]] == i
    return kept


def main_text(page: Page, probability: np.ndarray) -> str:
    kept = decode(page, probability)
    return "\n".join(t for t, tag, k in zip(page.text, page.tag, kept, strict=True) if k and tag == LEAF)


def extract(sources: list[str], model: Boosted) -> list[str]:
    """The main text of each page; all their nodes are judged together."""
    pages = [parse(s) for s in sources]
    rows = [node_features(p) for p in pages]
    scores = model.probability(np.concatenate(rows)) if rows else np.zeros(0)
    texts, at = [], 0
    for page in pages:
        texts.append(main_text(page, scores[at : at + len(page.tag)]))
        at += len(page.tag)
    return texts


def sample_page(rng: random.Random) -> str:
    """A made page; what belongs to the article is between the marks \\x01 and \\x02."""
    pick = rng.choice
    syllables = "the and tion ing er ou re en es an st nd le de la un ch be ge sch que ment os ado".split()
    word = lambda: "".join(pick(syllables) for _ in range(rng.randint(1, 4)))
    phrase = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))

    def prose(a: int, b: int) -> str:
        out = []
        for _ in range(rng.randint(a, b)):
            out.append(phrase(1, 18).capitalize() + pick((".", ".", ".", "!", "?")))
        text = " ".join(out)
        if rng.random() < 0.2:
            cut = text.find(" ", len(text) // 2)
            text = f"{text[:cut]} <a href='/{word()}'>{phrase(1, 3)}</a>{text[cut:]}" if cut > 0 else text
        return pick((text, text, text, f"<b>{text}</b>", f"<span>{text}</span>", text + " &amp; " + word()))

    named = rng.random() < 0.7
    semantic = rng.random() < 0.65

    def box(tag: str, names: tuple[str, ...], inner: str, always: bool = False) -> str:
        tag = tag if semantic or always else "div"
        attrs = f' {pick(("class", "class", "id"))}="{pick(names)}"' if named and (rng.random() < 0.85 or tag == "div") else ""
        return f"<{tag}{attrs}>{inner}</{tag}>"

    def links(k: int) -> str:
        items = "".join(f'<li><a href="/{word()}">{phrase(1, 3)}</a></li>' for _ in range(k))
        return f"<ul>{items}</ul>" if rng.random() < 0.7 else re.sub(r"</?li>", " ", items)

    ad = lambda: box("div", ("ad", "ads", "advert", "sponsored", "promo banner", "ad-slot"), pick((prose(1, 2), f"<p>{prose(1, 2)}</p>", f"<a href='x'>{phrase(2, 8)}</a>")), True)
    nav = lambda: box("nav", ("nav", "menu", "navbar", "main-menu", "breadcrumb"), links(rng.randint(3, 10)))
    notice = lambda: box("div", ("cookie-notice", "notice", "consent", "alert", "gdpr popup"), f"<p>{prose(1, 3)}</p><button>ok</button>", True)
    form = lambda: f"<form><p>{prose(1, 1)}</p><label>{word()}</label><input name=q><button>{word()}</button></form>"
    share = lambda: box("div", ("share", "social", "sharing-tools"), links(rng.randint(2, 5)), True)

    def paragraph() -> str:
        r = rng.random()
        text = prose(1, 6) if rng.random() < 0.8 else phrase(1, 2).capitalize() + "."
        if r < 0.72:
            return f"<p>{text}" + ("</p>" if rng.random() < 0.8 else "")
        if r < 0.78:
            return f"<h2>{phrase(1, 6)}</h2>"
        if r < 0.83:
            return "<ul>" + "".join(f"<li>{prose(1, 2)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>"
        if r < 0.87:
            return f"<blockquote><p>{prose(1, 3)}</p></blockquote>"
        if r < 0.90:
            return f"<table><tr><td>{phrase(1, 4)}</td><td>{prose(1, 1)}</td></tr><tr><td>{word()}</td><td>{word()}</td></tr></table>"
        if r < 0.93:
            return f"<pre>{phrase(3, 20)}</pre>"
        if r < 0.96:
            return f"<figure><img src=x><figcaption>{prose(1, 1)}</figcaption></figure>"
        return f"<div>{text}</div>" if r < 0.98 else f"{text}<br>{prose(1, 2)}<br>"

    body = [f"<h1>{phrase(2, 9)}</h1>"] if rng.random() < 0.75 else []
    for _ in range(pick((1, 1, 2, 3, 4, 6, 9, 14))):
        body.append(paragraph())
        if rng.random() < 0.06:
            body.append("\x02" + pick((ad, form, share))() + "\x01")
    inner = "\x01" + "".join(body) + "\x02"
    shell = rng.random()
    if shell < 0.08:
        article = inner
    else:
        article = box(pick(("article", "article", "main", "section")), ("article", "content", "post", "entry-content", "story", "main-content", "post body"), inner)
        if shell < 0.3:
            article = box(pick(("main", "div")), ("page", "wrapper", "content", "main", "container"), article)
    head = []
    if rng.random() < 0.5:
        head.append(box("header", ("header", "masthead", "site-header", "top"), f"<h1>{phrase(1, 3)}</h1>" * (rng.random() < 0.5) + f"<p>{phrase(2, 7)}</p>" + nav() * (rng.random() < 0.5)))
    if rng.random() < 0.8:
        head.append(nav())
    if rng.random() < 0.6:
        head.append(ad())
    if rng.random() < 0.3:
        head.append(notice())
    if rng.random() < 0.2:
        head.append(form())
    rng.shuffle(head)
    tail = []
    if rng.random() < 0.4:
        tail.append(box("aside", ("sidebar", "side", "widget", "related"), f"<h2>{phrase(1, 3)}</h2>" + pick((links(rng.randint(3, 8)), f"<p>{prose(1, 3)}</p>"))))
    if rng.random() < 0.4:
        posts = "".join(f"<div class='comment'><b>{word()}</b><p>{prose(1, 4)}</p></div>" for _ in range(rng.randint(1, 6)))
        tail.append(box("section", ("comments", "discussion", "replies", "comment-list"), f"<h2>{phrase(1, 2)}</h2>" + posts))
    if rng.random() < 0.3:
        tail.append(pick((ad, share, notice, form))())
    if rng.random() < 0.85:
        mark = pick(("&copy; ", "&copy; 2024 ", "", "(c) "))
        tail.append(box("footer", ("footer", "foot", "bottom", "legal", "copyright"), pick((f"{mark}{phrase(1, 3)} &middot; {prose(1, 3)}", f"<p>{mark}{prose(1, 2)}</p>" + links(3), links(5)))))
    if rng.random() < 0.02:
        head, tail = [], []
    return (
        f"<!DOCTYPE html><html><head><title>{phrase(2, 6)}</title><style>p{{}}</style></head><body>{''.join(head)}<!-- x -->{article}{''.join(tail)}"
        + pick(("</body></html>", ""))
    )


def _labelled(source: str) -> tuple[Page, np.ndarray]:
    """The nodes of a made page; a node is of the article if it holds a text that is."""
    depth, out = 0, []
    for piece in re.split("(<[^>]*>|[\x01\x02])", source):
        if piece in ("\x01", "\x02"):
            depth = int(piece == "\x01")
        elif piece and depth and not piece.startswith("<") and piece.strip():
            out.append("\x03" + piece)
        else:
            out.append(piece)
    page = parse("".join(out))
    label = [int("\x03" in t) for t in page.text]
    page.text = [t.replace("\x03", "") for t in page.text]
    for i in range(len(label) - 1, 0, -1):
        label[page.parent[i]] |= label[i]
    return page, np.array(label, float)


@functools.cache
def train(pages: int = TRAINING_PAGES, seed: int = 17) -> Boosted:
    rng = random.Random(seed)
    made = [_labelled(sample_page(rng)) for _ in range(pages)]
    # What text without tags looks like.
    made += [_labelled("\x01" + "word and more words here. " * k + "\x02") for k in (1, 3, 20)]
    x = np.concatenate([node_features(page) for page, _ in made])
    return Boosted.fit(x, np.concatenate([label for _, label in made]), rounds=60, depth=4, rate=0.2)


def extract_column(pages: DataFrame, carried: list[str], source: str = "html", model: Boosted | None = None) -> DataFrame:
    """The carried columns with the main text of each page and its length."""
    sent = pages.sparkSession.sparkContext.broadcast(train() if model is None else model)

    def report(group: list[bytes]) -> list[pa.Array]:
        texts = extract([g.decode("utf-8", "replace") for g in group], sent.value)
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    made = map_texts(pages, source, carried, [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())], report)
    return made.select("row.*", F.col("text"), F.col("n_chars"))


@query("op2_html_extraction")
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_column(table(spark, sf_dir, "pages"), ["page_id", "url"])
