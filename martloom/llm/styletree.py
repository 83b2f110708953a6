"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree of styles: elements under the same path of tags, classes
and ids fall together (digits in names don't count). For each node the tree knows how its children's
styles vary over the host's pages, and how the text of its whole branch does. Both entropies,
relative to that of the pages' texts as a whole, make its importance: a branch that stays the same
though the pages differ is low and goes, inside articles too. Copies of a page differ in nothing and
so say nothing. What tags, classes, ids and roles tell is a prior:

* what can only be menus, adverts, comments and the like has no importance;
* a branch whose name or tag may as well be a wrapper's (`sidebar`, `widget`, `form`), and one beside
  an article, is in doubt: it stays if over the host's pages it holds enough of the text;
* articles, what holds them, and plain paragraphs and headings in them are never low; other branches
  in articles must be lower than elsewhere to go.

Branches in doubt on few pages are judged by their page alone. A page never loses its whole text to
entropy.

Yi, Liu and Li, "Eliminating noisy information in web pages for data mining" (2003).
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.tables import unused
from martloom.shared import written

#: A node's importance is this part content and the rest style.
CONTENT_PART = 0.9
LOW = 0.2
#: A branch of an article goes below this.
LOW_IN_ARTICLE = 0.1
#: On fewer pages than this, a branch is not judged by its host; copies count once for entropy.
MIN_PAGES = 4
#: So many like containers beside each other are nodes of their own in the tree.
TOLD_APART = 8
#: A branch beside an article stays from this part of the article's text on.
BESIDE = 1 / 4
#: A wrapper holds this part of the pages' text, or this part of their articles.
WRAPS_TEXT, WRAPS_ARTICLE = 3 / 4, 1 / 2

# HTML elements by their role in this module.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNREAD = frozenset(
    "script style title noscript template iframe object svg math textarea select canvas audio"
    " video".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp"
    " rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
ARTICLES = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 dt th caption legend summary figcaption".split())
PLAIN = HEADINGS | frozenset("p ul ol li dl dd table thead tbody tr td blockquote pre figure".split())
CONTAINERS = frozenset("div section ul ol dl table form fieldset".split())
NOISE_TAGS = frozenset("nav footer aside button dialog menu head input option".split())
DOUBTFUL_TAGS = frozenset(("form", "fieldset"))
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split()
)
NOISE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors cookie"
    " cookies consent gdpr comment comments respond replies disqus footer".split()
)
DOUBTFUL_NAMES = frozenset(
    "promo promotion banner banners notice notices alert popup modal overlay nav navbar navigation"
    " menu menus breadcrumb breadcrumbs sidebar sidebars aside masthead share sharing social related"
    " recommended recommendations newsletter subscribe subscription signup login search pagination"
    " pager widget widgets hidden".split()
)
#: A start tag closes open elements of these kinds first.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",),
}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"([A-Za-z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?"
)
_UNREAD_END = {tag: re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I) for tag in UNREAD}
_NAMES = re.compile(r"[a-z]+")
#: 'has-sidebar' and 'no-comments' tell about the page, not about the element.
QUALIFIERS = frozenset("has no with without".split())
#: 'sidebar-layout' is the page's layout.
WRAPPERS = frozenset("layout page template".split())


@dataclass
class Page:
    """Elements in document order, as parallel lists, and the pieces of text between them."""

    tags: list[str] = field(default_factory=lambda: ["#page"])
    parents: list[int] = field(default_factory=lambda: [-1])
    labels: list[str] = field(default_factory=lambda: ["#page"])
    #: noise by its prior, or in such an element
    noise: list[bool] = field(default_factory=lambda: [False])
    #: by its name either noise or a wrapper
    doubtful: list[bool] = field(default_factory=lambda: [False])
    #: an article, or in one
    article: list[bool] = field(default_factory=lambda: [False])
    #: (element, text), or (element, None) where a block begins or ends
    pieces: list[tuple[int, str | None]] = field(default_factory=list)


def _telling(classes: str) -> set[str]:
    """The words of class names and ids, up to a qualifier in each."""
    out: set[str] = set()
    for name in classes.split():
        words = _NAMES.findall(name)
        if not words or words[-1] in WRAPPERS:
            continue
        for word in words:
            if word in QUALIFIERS:
                break
            out.add(word)
    return out


def _described(tag: str, raw: str) -> tuple[str, bool, bool, bool]:
    """The element's label in the style tree; whether it is noise, in doubt, an article."""
    noise, doubtful, article = tag in NOISE_TAGS, tag in DOUBTFUL_TAGS, tag in ARTICLES
    if not raw or raw.isspace():
        return tag, noise, doubtful, article
    given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)}
    classes = f"{given.get('class', '')} {given.get('id', '')}".lower()
    names, telling = _NAMES.findall(classes), _telling(classes)
    role = given.get("role", "").lower()
    hidden = (
        "hidden" in given
        or given.get("aria-hidden", "").lower() == "true"
        or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style", "").lower())
    )
    label = ".".join([tag, *names, *([role] if role else [])])
    noise = bool(noise or role in NOISE_ROLES or hidden)
    if tag not in INLINE and (role == "main" or given.get("id", "").lower() == "main"):
        article = True
    if article:
        noise = noise or not telling.isdisjoint(("comment", "comments"))
    elif tag not in ("html", "body"):
        noise = noise or not telling.isdisjoint(NOISE_NAMES)
        doubtful = doubtful or role == "form" or not telling.isdisjoint(DOUBTFUL_NAMES)
    return label, noise, doubtful, article and not noise


def _heads_the_page(tag: str, label: str) -> bool:
    """Outside an article, such a header is the site's."""
    return tag == "header" or label == f"{tag}.header"


def parsed(html: str | None) -> Page:
    """A lenient reading: unclosed, misplaced and cut-off tags are taken as browsers would."""
    page = Page()
    text = html or ""
    stack, at = [0], 0

    def close_to(depth: int) -> None:
        for node in reversed(stack[depth:]):
            if page.tags[node] not in INLINE:
                page.pieces.append((page.parents[node], None))
        del stack[depth:]

    while at < len(text):
        found = _TAG.search(text, at)
        until = found.start() if found else len(text)
        if until > at:
            piece = text[at:until]
            page.pieces.append((stack[-1], entities.unescape(piece) if "&" in piece else piece))
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if page.tags[stack[depth]] == tag:
                    close_to(depth)
                    break
            continue
        if tag == "br":
            page.pieces.append((stack[-1], " "))
            continue
        if tag not in INLINE:
            ends = CLOSES.get(tag, ()) + (("p",) if tag not in VOID else ())
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = page.tags[stack[depth]]
                if open_tag in ends:
                    close_to(depth)
                    break
                if open_tag not in INLINE and not (tag == "tr" and open_tag in ("td", "th")):
                    break
        if tag in UNREAD:
            end = _UNREAD_END[tag].search(text, at)
            at = end.end() if end else len(text)
            continue
        label, noise, doubtful, article = _described(tag, found[3])
        parent = stack[-1]
        node = len(page.tags)
        page.tags.append(tag)
        page.parents.append(parent)
        page.labels.append(label)
        noise = noise or not page.article[parent] and _heads_the_page(tag, label)
        page.noise.append(noise or page.noise[parent])
        page.doubtful.append(doubtful)
        page.article.append(page.article[parent] or article)
        if tag not in INLINE:
            page.pieces.append((parent, None))
        if tag not in VOID and not found[3].rstrip().endswith("/"):
            stack.append(node)
        elif tag not in INLINE:
            page.pieces.append((parent, None))
    close_to(1)
    return page


def style_paths(page: Page) -> list[int]:
    """A 63-bit key of each element's path of labels. Like containers beside each other are told
    apart: the last, the first ones by their place, and the rest as one."""
    last: dict[tuple[int, str], int] = {}
    for node, (parent, label) in enumerate(zip(page.parents, page.labels)):
        if page.tags[node] in CONTAINERS:
            last[parent, label] = node
    seen: dict[tuple[int, str], int] = {}
    keys = [0]
    for node in range(1, len(page.tags)):
        like = page.parents[node], page.labels[node]
        name = like[1]
        if page.tags[node] in CONTAINERS:
            at = seen[like] = seen.get(like, -1) + 1
            name += "#last" if node == last[like] else f"#{min(at, TOLD_APART)}"
        keys.append(xxhash.xxh3_64_intdigest(f"{keys[like[0]]}/{name}") >> 1)
    return keys


@dataclass
class Branches:
    """What the branches of a page hold outside noise, and which of them are in doubt."""

    #: hash of the branch's text, 0 without text
    content: list[int]
    #: for elements in doubt: (what it and those like it beside it hold, what they need to stay)
    claims: dict[int, tuple[float, float]]
    #: has an article inside and is in none
    holds: list[bool]


def branches(page: Page) -> Branches:
    count = len(page.tags)
    content, size, told, holds = [0] * count, [0] * count, [0] * count, [False] * count
    for node, text in page.pieces:
        if text and not page.noise[node] and (words := text.split()):
            content[node] = xxhash.xxh3_64_intdigest(f"{content[node]} {' '.join(words)}") >> 1
            here = sum(map(len, words))
            size[node] += here
            told[node] += here if page.article[node] else 0
    for node in range(count - 1, 0, -1):
        if page.noise[node]:
            continue
        parent = page.parents[node]
        size[parent] += size[node]
        told[parent] += told[node]
        holds[parent] |= holds[node] or page.article[node] and not page.article[parent]
        if content[node]:
            content[parent] = xxhash.xxh3_64_intdigest(f"{content[parent]}+{content[node]}") >> 1
    doubts: dict[tuple, list[int]] = {}
    for node in range(1, count):
        parent = page.parents[node]
        if page.noise[node] or not size[node]:
            continue
        beside = (
            holds[parent]
            and not (holds[node] or page.article[node])
            and page.tags[node] not in INLINE
        )
        if page.doubtful[node] or beside:
            like = parent, page.labels[node], holds[node], page.doubtful[node]
            doubts.setdefault(like, []).append(node)
    claims: dict[int, tuple[float, float]] = {}
    for (_, _, with_article, named), nodes in doubts.items():
        if with_article:
            claim = sum(told[n] for n in nodes), WRAPS_ARTICLE * told[0]
        else:
            needed = WRAPS_TEXT * size[0] if named else BESIDE * told[0]
            claim = sum(size[n] for n in nodes), needed
        claims.update(dict.fromkeys(nodes, claim))
    return Branches(content, claims, holds)


def _may_be_low(page: Page, inside: Branches, node: int) -> bool:
    """Whether entropy may speak against the element: not what holds an article or is its root, and
    no part of a sentence, bare heading or, in articles, bare block."""
    tag, parent = page.tags[node], page.parents[node]
    if page.noise[node] or inside.holds[node] or tag in ("html", "body"):
        return False
    bare = page.labels[node] == tag
    if page.article[node]:
        return page.article[parent] and tag not in INLINE and not (bare and tag in PLAIN)
    on_top = page.tags[parent] in ("#page", "html", "body")
    return on_top or tag not in INLINE and not (bare and tag in HEADINGS)


def style_nodes(page: Page, inside: Branches) -> list[tuple]:
    """(path, hash of the child styles, hash of the branch's text, whether entropy may speak against
    it, whether it is in an article, what it claims and what it needs if in doubt) for each path
    that is not noise and holds text. Elements of one path are one node."""
    keys = style_paths(page)
    styles: dict[int, list[str]] = {}
    for node in range(1, len(keys)):
        if not page.noise[node]:
            siblings = styles.setdefault(keys[page.parents[node]], [])
            if not siblings or siblings[-1] != page.labels[node]:
                siblings.append(page.labels[node])
    texts: dict[int, list[int]] = {}
    judged: dict[int, bool] = {}
    in_article: dict[int, bool] = {}
    claims: dict[int, tuple[float, float]] = {}
    for node in range(1, len(keys)):
        if not inside.content[node] or page.noise[node]:
            continue
        key = keys[node]
        texts.setdefault(key, []).append(inside.content[node])
        judged[key] = judged.get(key, True) and _may_be_low(page, inside, node)
        in_article[key] = page.article[node]
        if node in inside.claims:
            claims[key] = max(claims.get(key, (-1.0, 0.0)), inside.claims[node])

    def digest(parts) -> int:
        return xxhash.xxh3_64_intdigest(" ".join(map(str, parts))) >> 1

    return [
        (key, digest(styles.get(key, ())), digest(texts[key]), judged[key], in_article[key],
         *claims.get(key, (None, None)))
        for key in texts
        if judged[key] or key in claims
    ]


@dataclass(frozen=True)
class Verdicts:
    """Paths of a host that are low, and paths in doubt that stay or go on all its pages."""

    low: frozenset[int] = frozenset()
    stay: frozenset[int] = frozenset()
    go: frozenset[int] = frozenset()


def main_text(page: Page, of: Verdicts = Verdicts()) -> str:
    """Blocks of the branches that are not noise, low or dropped in doubt."""
    keys, inside = style_paths(page), branches(page)

    def blocks(low: frozenset[int]) -> list[str]:
        gone = [False] * len(keys)
        for node in range(1, len(keys)):
            key = keys[node]
            gone[node] = gone[page.parents[node]] or page.noise[node]
            if not gone[node] and node in inside.claims and key not in of.stay:
                gone[node] = key in of.go or inside.claims[node][0] < inside.claims[node][1]
            if not gone[node] and key in low:
                gone[node] = _may_be_low(page, inside, node)
        out: list[str] = []
        block: list[str] = []
        for node, text in page.pieces:
            if text is None:
                if block and (line := " ".join("".join(block).split())):
                    out.append(line)
                block = []
            elif not gone[node]:
                block.append(text)
        if block and (line := " ".join("".join(block).split())):
            out.append(line)
        return out

    return "\n".join(blocks(of.low) or blocks(frozenset()))


_NODE = (
    "host string, whole long, path long, style long, content long, judged boolean,"
    " in_article boolean, held double, needed double"
)


def _entropy(kind: str) -> Column:
    """Of the variants of one kind, in nats."""
    times = F.when(F.col("kind") == kind, F.col("count"))
    n = F.sum(times)
    return F.greatest(F.log(n) - F.sum(times * F.log(times)) / n, F.lit(0.0))


def verdicts(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, path, verdict) of the style tree of each host of `pages(host, html)`: `low` by entropy,
    and `stay` or `go` for branches in doubt on at least `min_pages` pages.

    Equal variants of a node are counted, first in every task. The entropies of a node's texts and
    child styles are relative to that of the texts of all the pages it is on, which must be that of
    `min_pages` different pages at least.
    """

    def nodes(batches):
        for batch in batches:
            rows = []
            for host, text in zip(batch["host"], batch["html"]):
                page = parsed(text)
                inside = branches(page)
                rows += [(host, inside.content[0], *node) for node in style_nodes(page, inside)]
            names = [c.split()[0] for c in _NODE.split(", ")]
            yield pd.DataFrame(rows, columns=names)

    found = pages.select("host", "html").mapInPandas(nodes, _NODE)
    kinds = [
        F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("variant"))
        for kind in ("style", "content", "whole")
    ]
    first = F.col("kind") == "whole"
    counted = (
        found.select("host", "path", "judged", "in_article", "held", "needed",
                     F.explode(F.array(*kinds)).alias("v"))
        .groupBy("host", "path", "v.kind", "v.variant")
        .agg(
            F.count("*").alias("count"), F.count("needed").alias("doubts"),
            F.bool_and("judged").alias("judged"), F.bool_or("in_article").alias("in_article"),
            F.sum("held").alias("held"), F.sum("needed").alias("needed"),
        )
    )
    tree = counted.groupBy("host", "path").agg(
        *[_entropy(kind).alias(kind) for kind in ("style", "content", "whole")],
        F.bool_and("judged").alias("judged"), F.bool_or("in_article").alias("in_article"),
        *[F.sum(F.when(first, F.col(c))).alias(c) for c in ("doubts", "held", "needed")],
    )
    part = CONTENT_PART * F.col("content") + (1 - CONTENT_PART) * F.col("style")
    bound = F.when(F.col("in_article"), LOW_IN_ARTICLE).otherwise(LOW)
    # a hair of slack for sums of logarithms
    low = F.col("judged") & (F.exp("whole") > min_pages - 1e-9) & (part < bound * F.col("whole"))
    doubt = F.when(F.col("held") >= F.col("needed"), "stay").otherwise("go")
    both = F.array(F.when(low, F.lit("low")), F.when(F.col("doubts") >= min_pages, doubt))
    return tree.select("host", "path", F.explode(F.array_compact(both)).alias("verdict"))


def extract(pages: DataFrame) -> DataFrame:
    """`pages(page_id, url, html, ...)` with columns text and n_chars (which replace columns of
    those names), one row per row; other columns may have any name.

    The host is that of the url; pages without a readable one share the host ''. NULL or empty html
    gives an empty text. Repeated rows give equal texts. An empty table gives no rows.
    """
    names = [f for f in pages.schema if f.name not in ("text", "n_chars")]
    host, of, low, stay, go = unused(pages, "host", "of", "low", "stay", "go")
    hosted = pages.select(
        *[F.col(f"`{f.name}`") for f in names],
        F.coalesce(F.lower(F.try_parse_url("url", F.lit("HOST"))), F.lit("")).alias(host),
    )
    judged = written(verdicts(hosted.select(F.col(host).alias("host"), "html")), "style-verdicts")
    # a host's template has few such branches; written first, so that their size is known
    by_host = judged.groupBy(F.col("host").alias(of)).agg(
        *[F.collect_set(F.when(F.col("verdict") == v, F.col("path"))).alias(name)
          for v, name in (("low", low), ("stay", stay), ("go", go))]
    )
    joined = hosted.join(by_host, F.col(f"`{host}`") == F.col(f"`{of}`"), "left").drop(host, of)
    kept = [f.name for f in names]

    def texts(batches):
        for batch in batches:
            out = batch[kept].copy()
            out["text"] = [
                main_text(parsed(text), Verdicts(*(frozenset(() if s is None else s) for s in sets)))
                for text, *sets in zip(batch["html"], batch[low], batch[stay], batch[go])
            ]
            out["n_chars"] = out["text"].map(len).astype(np.int64)
            yield out

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in names)
    return joined.mapInPandas(texts, f"{schema}, text string, n_chars long")
