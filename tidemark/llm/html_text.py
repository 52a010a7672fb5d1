"""Main text of web pages by consensus of each host's container paths."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.staging import column, pieces, staged, text_column

# What HTML elements are, and the words by which sites name what is not the article.
#: Their content is not text, up to the page's end if they stay open.
RAW = "script style title textarea".split()
#: Their content is not text if they are closed; left open they hide nothing.
HIDDEN = "template noscript iframe svg math object canvas select button xmp".split()
#: They may hold the article, and form paths.
CONTAINERS = ("html body div section article main nav header footer aside form ul ol dl table tbody thead tfoot tr td th blockquote figure "
              "details fieldset dialog center").split()
#: They begin and end a block of text.
BLOCKS = "p h1 h2 h3 h4 h5 h6 li dt dd pre address figcaption caption summary legend hr option".split()
SPACED = "br img wbr input".split()
#: They may be the article's container; lists, tables and quotes are parts of an article.
VOTED = "html body div section article main td center".split()
OUTSIDE_TAGS = "nav header footer aside form dialog".split()
OUTSIDE_WORDS = ("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navigation navbar menu breadcrumb "
                 "breadcrumbs header masthead footer sidebar aside widget cookie cookies consent gdpr notice notices banner alert popup modal "
                 "overlay newsletter subscribe signup login search share sharing social related recommended comment comments respond disqus "
                 "reply replies discussion form copyright legal pagination pager toolbar skip").split()
#: Inside a named article, and on blocks and inline elements, fewer names say so: words in any part of a class or id, and whole classes or ids.
STRONG_WORDS = ("ad ads advert adverts advertisement advertising sponsored comment comments disqus cookie cookies gdpr newsletter navbar "
                "breadcrumb breadcrumbs sidebar").split()
WHOLE_NAMES = ("sponsor promo promotion nav navigation menu footer aside widget consent notice notices banner alert popup modal overlay subscribe "
               "signup login search share sharing social social-share share-buttons related related-posts related-articles recommended respond "
               "reply replies discussion form copyright legal pagination pager toolbar skip skip-link").split()
OUTSIDE_ROLES = "navigation banner contentinfo complementary search form alert dialog menu".split()
MAIN_WORDS = "article content post entry story main text body".split()

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_UNSEEN = re.compile(r"""(?:^|\s)hidden(?=[\s/=]|$)""", re.I)
_QUOTED = re.compile(r""""[^"]*"|'[^']*'""")
_HEADING = re.compile(r"h[1-6]")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW}
_PART = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"\d+")
_RAW_SET, _HIDDEN_SET, _CONTAINER_SET, _BLOCK_SET, _SPACED_SET = set(RAW), set(HIDDEN), set(CONTAINERS), set(BLOCKS), set(SPACED)
_OUTSIDE_TAGS, _OUTSIDE_WORDS, _OUTSIDE_ROLES, _MAIN_WORDS = set(OUTSIDE_TAGS), set(OUTSIDE_WORDS), set(OUTSIDE_ROLES), set(MAIN_WORDS)
_STRONG_WORDS, _WHOLE_NAMES = set(STRONG_WORDS), set(WHOLE_NAMES)

#: A share of a page's text that makes a container its main one, one that a winner must hold to count for a page, and a share of a
#: host's pages that makes a path a winner. They choose between containers; what the chosen one holds is kept at any length.
MOST_TEXT, LEAST_HELD, LEAST_VOTES = 0.7, 0.5, 0.1
#: Winners are broadcast up to this many bytes; beyond, pages and winners meet by shuffle.
MOST_BROADCAST, SALTS = 32 << 20, 16


@dataclass
class Element:
    """An open container: its tag, generalised step of the path, and what its names say."""

    tag: str
    path: str
    outside: bool
    main: bool


@dataclass
class Block:
    """A block's text, the path of its container, and the characters of it that are links; whether it lies in a named article, in an
    element of its own (a paragraph, an item), and whether that is a heading."""

    path: str
    outside: bool
    text: str
    linked: int
    main: bool
    own: bool
    heading: bool


@dataclass
class Page:
    """Blocks in page order."""

    blocks: list[Block] = field(default_factory=list)


def _found(attributes: str) -> dict[str, str]:
    found = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in attributes.lower() and _UNSEEN.search(_QUOTED.sub("", attributes)):
        found["hidden"] = ""
    return found


def _strongly_outside(found: dict[str, str]) -> bool:
    """What excludes inside a named article, and excludes blocks and inline elements anywhere."""
    names = f"{found.get('class', '')} {found.get('id', '')}"
    words = {w.lower() for w in _PART.split(names)}
    return "hidden" in found or found.get("role", "").lower() in _OUTSIDE_ROLES or bool(words & _STRONG_WORDS) \
        or not _WHOLE_NAMES.isdisjoint(names.lower().split())


def _element(tag: str, attributes: str, parent: Element | None) -> Element:
    found = _found(attributes) if attributes else {}
    classes = sorted({_DIGITS.sub("#", c) for c in found.get("class", "").split()})
    in_main = parent is not None and parent.main
    main = tag in ("article", "main") or found.get("role", "").lower() == "main" or found.get("itemprop", "") == "articleBody"
    if in_main:
        # An article's own header holds its title, whatever the words in its classes.
        outside = (tag in _OUTSIDE_TAGS and tag != "header") or _strongly_outside(found)
    else:
        words = {w.lower() for w in _PART.split(f"{found.get('class', '')} {found.get('id', '')}") if w}
        outside = tag in _OUTSIDE_TAGS or "hidden" in found or bool(words & _OUTSIDE_WORDS and tag not in ("body", "html", "article", "main")) \
            or found.get("role", "").lower() in _OUTSIDE_ROLES or (tag in ("article", "main") and _strongly_outside(found))
    step = ".".join([tag, *classes])
    outside = outside or (parent is not None and parent.outside)
    return Element(tag, f"{parent.path}/{step}" if parent else step, outside, in_main or (main and not outside))


@lru_cache(maxsize=256)
def _tags(tag: str) -> re.Pattern:
    return re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*>", re.I)


def _closed(source: str, tag: str) -> dict[int, int]:
    """Where each element of a tag begins, and where its own end tag ends; elements left open are not listed."""
    opened, closed = [], {}
    for token in _tags(tag).finditer(source):
        if token[1]:
            if opened:
                closed[opened.pop()] = token.end()
        elif not token[0].endswith("/>"):
            opened.append(token.start())
    return closed


def read_page(source: str) -> Page:
    """Blocks of text with their containers. Unclosed and stray tags do no harm, but for an open script, style, title or
    textarea, which takes the rest of the page as in browsers. ``head`` needs no end tag: what it may hold is not text anyway.

    A block that its names put outside ends where the next block or container begins or ends; an inline element left open hides nothing.
    """
    page, stack, text, links, link_from, at = Page(), [], [], 0, None, 0
    size, closed = 0, {}
    block = block_outside = None

    def flush() -> None:
        nonlocal links, link_from, size
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                if link_from is not None:
                    links += size - link_from
                top = stack[-1] if stack else None
                page.blocks.append(Block(top.path if top else "", bool((top and top.outside) or block_outside), joined, min(links, len(joined)),
                                         bool(top and top.main), block is not None or bool(top and top.tag not in VOTED), bool(block and _HEADING.fullmatch(block))))
            text.clear()
        links, size = 0, 0
        link_from = 0 if link_from is not None else None

    def add(raw: str) -> None:
        nonlocal size
        if raw:
            plain = html.unescape(raw) if "&" in raw else raw
            text.append(plain)
            size += len(plain)

    def end_of(tag: str, start: int) -> int | None:
        if tag not in closed:
            closed[tag] = _closed(source, tag)
        return closed[tag].get(start)

    while True:
        token = _TOKEN.search(source, at)
        if token is None:
            add(source[at:])
            break
        add(source[at:token.start()])
        at = token.end()
        closing, tag, attributes = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag in _RAW_SET and not closing:
            flush()
            end = _RAW_END[tag].search(source, at)
            if not (attributes or "").endswith("/"):
                at = end.end() if end else len(source)
        elif tag in _HIDDEN_SET:
            flush()
            if not closing:
                at = end_of(tag, token.start()) or at
        elif tag in _CONTAINER_SET:
            flush()
            link_from = block = block_outside = None
            if closing:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].tag == tag:
                        del stack[k:]
                        break
            else:
                stack.append(_element(tag, attributes or "", stack[-1] if stack else None))
        elif tag in _BLOCK_SET:
            flush()
            link_from = None
            block = None if closing else tag
            block_outside = not closing and bool(attributes) and _strongly_outside(_found(attributes))
        elif tag in _SPACED_SET:
            text.append(" ")
        elif not closing and attributes and tag not in ("a", "b", "i") and _strongly_outside(_found(attributes)):
            at = end_of(tag, token.start()) or at
        elif tag == "a":
            if link_from is not None:
                links += size - link_from
            link_from = None if closing else size
            if not closing and attributes and _strongly_outside(_found(attributes)):
                end = end_of(tag, token.start())
                link_from, at = (None, end) if end else (link_from, at)
    flush()
    return page


def _within(path: str, container: str) -> bool:
    return path == container or path.startswith(container + "/") or not container


def _weight(block: Block) -> int:
    """Characters of text that speak for a container; links speak against it."""
    return max(len(block.text) - 2 * block.linked, 0)


def _common(paths: list[str]) -> str:
    """The smallest container around some paths."""
    steps = [p.split("/") for p in paths]
    same = 0
    while all(len(s) > same for s in steps) and len({s[same] for s in steps}) == 1:
        same += 1
    return "/".join(steps[0][:same])


def best_path(page: Page) -> str | None:
    """The page's own vote: the smallest container around its named articles, else the deepest one of VOTED with most of the page's
    text (one with a main word in its name first), or the smallest around it that holds every part of the article.

    A part is a container with a paragraph, heading, item or quote that isn't all links, at any length. A hinting name is not climbed out of.
    """
    inside = [b for b in page.blocks if not b.outside]
    weights: Counter = Counter()
    for block in inside:
        weights[block.path] += _weight(block)
    total = sum(weights.values())
    named = [b.path for b in inside if b.main]
    if named:
        return _common(named)
    if not total:
        return None
    held: Counter = Counter()
    for path, weight in weights.items():
        steps = path.split("/")
        for k in range(1, len(steps) + 1):
            held["/".join(steps[:k])] += weight
    hinted = [p for p in held if held[p] >= MOST_TEXT * total and set(_PART.split(p.rsplit("/", 1)[-1].lower())[1:]) & _MAIN_WORDS]
    if hinted:
        return max(hinted, key=lambda p: (p.count("/"), p))
    parts = {b.path for b in inside if b.own and _weight(b)}
    whole = [p for p in held if held[p] >= MOST_TEXT * total and p.rsplit("/", 1)[-1].split(".")[0] in VOTED and all(_within(x, p) for x in parts)]
    return max(whole, key=lambda p: (p.count("/"), p), default="")


def main_text(page: Page, winners: list[str]) -> str:
    """Blocks of the first winning container that holds most of this page's text, else of the page's own best one.

    Where the page names its article, only what lies in it counts. A heading that stands before the container, in one around it,
    belongs to the text if the container has no heading of its own.
    """
    inside = [b for b in page.blocks if not b.outside]
    counted = [b for b in inside if b.main] or inside
    total = sum(map(_weight, counted))
    for path in [*winners, best_path(page)]:
        if path is None:
            continue
        chosen = [b for b in counted if _within(b.path, path)]
        if chosen and (path not in winners or sum(map(_weight, chosen)) > LEAST_HELD * total):
            if not any(b.heading for b in chosen):
                before = page.blocks.index(chosen[0])
                titles = [b for b in page.blocks[:before] if b.heading and not b.outside and _within(chosen[0].path, b.path)]
                chosen = titles + chosen
            return "\n".join(b.text for b in chosen)
    return ""


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Votes of a batch's pages, added up by host and path."""
    for batch in batches:
        votes: Counter = Counter()
        for part in pieces(batch):
            for host, source in zip(text_column(part, "host").to_pylist(), text_column(part).to_pylist()):
                path = best_path(read_page(source))
                if path:  # a page without containers has no say
                    votes[host, path] += 1
        yield pa.record_batch({"host": pa.array([h for h, _ in votes], pa.string()), "path": pa.array([p for _, p in votes], pa.string()),
                               "votes": pa.array(list(votes.values()), pa.int64())})


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch):
            texts = [main_text(read_page(source), winners or []) for source, winners in zip(
                text_column(part).to_pylist(), column(part, "winners").to_pylist())]
            yield pa.record_batch({"id": column(part, "id"), "url": column(part, "url"), "main_text": pa.array(texts, pa.string())})


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, winners): the paths with at least a tenth of the host's votes, most votes first; so at most ten of them."""
    votes = pages.mapInArrow(_votes, "host string, path string, votes bigint").groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    totals = votes.groupBy("host").agg(F.sum("votes").alias("total"))
    won = votes.join(totals, "host").filter(F.col("votes") >= LEAST_VOTES * F.col("total"))
    ranked = won.groupBy("host").agg(F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("order"), "path"))).alias("ranked"))
    return ranked.select("host", F.col("ranked.path").alias("winners"))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, main_text): the article of each page, its blocks joined by line breaks.

    How: each page's containers are scored by their text without links, and the page votes for one generalised
    path (tags and classes, digits as #). Votes are added up per host in Spark; paths with a tenth of the votes
    win. Pages are read again and give the blocks under the host's first winning path that holds most of their text, or
    under their own best one. Several named articles are joined. Menus, headers, footers, sidebars, forms, adverts, notices and comments are told by tag, role and
    class words and left out at any depth.

    Null html is empty and gives an empty text; a null or odd url has an empty host. Repeated ids and urls get a row
    each. Other columns are ignored. Winners are broadcast while they are small (checked), else joined in slices of each host.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col).cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    own = pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).cast("string").alias("url"), host.alias("host"),
                       F.col(html_col).cast("string").alias("text"))
    winners = staged(host_paths(own.select("host", "text")), "host-paths").withColumnRenamed("host", "of_host")
    size = winners.agg(F.sum(F.octet_length("of_host") + F.octet_length(F.concat_ws("", "winners")) + 64)).first()[0] or 0
    if size <= MOST_BROADCAST:
        met = own.join(F.broadcast(winners), F.col("host") == F.col("of_host"), "left")
    else:
        sliced = winners.withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = own.withColumn("salt", F.pmod(F.xxhash64("url", "id"), F.lit(SALTS)).cast("int"))
        met = salted.join(sliced, (F.col("host") == F.col("of_host")) & (F.col("salt") == F.col("of_salt")), "left")
    out = met.select("id", "url", "text", "winners").mapInArrow(_extracted, "id bigint, url string, main_text string")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "main_text")
