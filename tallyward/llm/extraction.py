"""Main text of web pages by deducing each host's template.

Tokens of a page are its tags, named by their path, and its blocks of text. Tokens of a
host that occur equally often on each of its pages form an equivalence class; classes
that are large, frequent, ordered alike on all pages and nested in one another make the
host's template. What the template leaves open are slots. Content is what lies in the page's
article, whether other pages have it too or not; where no page says which part that is,
the slots from the first heading or running text to the last running text, without the
text of the template. Menus, notices, adverts
and other parts that their markup names are left out wherever they are.

A host whose pages are too few to tell a template from their content has none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.store import Scratch

#: A class counts if this part of the host's different pages have it, and at least so many.
SUPPORT = 0.6
PAGES = 8
#: Tokens of a class, at least.
SIZE = 3
#: Unlinked words, on average over the pages that fill it, that make a slot or block one of running text.
RUNNING = 5
#: Words of a page's longest block from which on it tells copies of the page.
TELLING = 10
#: What is known of all hosts is sent to all tasks up to this size (as text, which is longer than the rows), joined by shuffles beyond.
BROADCAST_BYTES = 64 << 20

#: Elements by their meaning in HTML.
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 head header hgroup hr html legend li link main menu meta nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
_EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_LEFT_OUT = frozenset("nav footer aside form button select menu dialog head label fieldset".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
#: Words in a class or id that name a part which is not the article.
_NAMES = frozenset(
    "ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notification nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer comment comments disqus "
    "reply replies respond share sharing social related recommended newsletter subscribe signup login popup modal overlay "
    "widget pagination pager toolbar skip masthead topbar".split()
)
#: Words after which such a word says what is there besides, and those that name any part if compounded.
_BESIDES = frozenset("has with no without is show hide hides".split())
_GENERIC = frozenset(("widget",))
#: Words of parts that may be longer than the article and hold articles of their own.
_TALK = frozenset("comment comments disqus reply replies respond related recommended".split())
_OUTER = frozenset(("html", "body", "main", "article"))

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|title|svg|iframe|select|xmp|noframes)\b[^>]*>.*?(?:</\1\b[^>]*>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|</?[a-zA-Z][^>]*(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_PARTS = re.compile(r"[^a-z0-9]+")


@dataclass
class Block:
    """A block's text, its tokens' hash, whether it lies in the article or a part to leave out, and words in links."""

    text: str
    token: int
    article: bool
    left_out: bool
    words: int
    linked: int
    after: int
    marks: tuple[int, ...] = ()
    heading: bool = False


@dataclass
class Page:
    """A page's tokens in order, and its blocks; ``after`` of a block is the number of tokens before it."""

    tokens: list[int] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)


def _named(value: str) -> str:
    """What a class or id says: ``talk`` or ``part`` for a part which is not the article, or nothing."""
    said = ""
    for name in value.split():
        parts = [p for p in _PARTS.split(name) if p]
        if len(parts) > 1:
            parts = [p for k, p in enumerate(parts) if p not in _GENERIC and _BESIDES.isdisjoint(parts[:k])]
        if not _NAMES.isdisjoint(parts):
            if not _TALK.isdisjoint(parts):
                return "talk"
            said = "part"
    return said


def _marked(tag: str, attributes: str, in_article: bool) -> str:
    """How an element's markup names a part that is not the article: ``fixed`` by its meaning, or as ``_named`` has it."""
    if tag in _LEFT_OUT or (tag == "header" and not in_article):
        return "fixed"
    if not attributes.strip() or tag in _OUTER:
        return ""
    said = ""
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id") and said != "talk":
            said = _named(value) or said
        if name == "role" and value in _ROLES:
            return "fixed"
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return "fixed"
        if name == "style" and "display:none" in value.replace(" ", ""):
            return "fixed"
    return said


def _leave_out(page: Page, marks: list[str], articles: list[tuple[int, ...]], heads: list[tuple[int, bool]]) -> None:
    """Leave out the blocks of marked parts, but not of those that hold the article or, without one, a heading or most of the text."""
    if not marks:
        return
    running = [0 if b.left_out else b.words - b.linked for b in page.blocks]
    own, inside, plain = [0] * len(marks), [0] * len(articles), 0
    headed = set()
    for block, words, (article, heading) in zip(page.blocks, running, heads, strict=True):
        for mark in block.marks:
            own[mark] += words
        if article >= 0:
            inside[article] += words
        elif not block.marks:
            plain += words
        if heading and words:
            headed.update(block.marks)
    whole = sum(running)
    free = {k for k, a in enumerate(articles) if not any(marks[m] == "talk" for m in a)}
    held: set[int] = set()
    # a card in a sidebar is not the article of a page that has more text outside of such parts
    if free and max(inside[k] for k in free) > plain:
        held.update(articles[max(free, key=lambda k: (inside[k], -k))])
    elif not articles or not free:
        held = {m for m, said in enumerate(marks) if said == "part" and (m in headed or 2 * own[m] > whole)}
    for block in page.blocks:
        block.left_out = block.left_out or any(m not in held for m in block.marks)


def parse(html: str) -> Page:
    """The page's tokens and blocks. Unclosed and stray tags are taken as browsers take them, roughly."""
    page, stack = Page(), []  # (tag, path, article, left out, link, marks, number of the outermost article)
    marks: list[str] = []
    articles: list[tuple[int, ...]] = []
    heads: list[tuple[int, bool]] = []
    held: list[str] = []
    linked = 0

    def top():
        return stack[-1] if stack else ("", 0, False, False, False, (), -1)

    def end_block() -> None:
        nonlocal linked
        if held:
            words = "".join(held).split()
            if words:
                text = " ".join(words)
                tag, path, article, left_out, _, named, number = next((s for s in reversed(stack) if s[0] in _BLOCKS), top())
                token = xxhash.xxh64_intdigest(text, seed=path & 0xFFFFFFFF)
                page.blocks.append(Block(text, token, article, left_out, len(words), linked, len(page.tokens), named, tag in ("h1", "h2", "h3")))
                heads.append((number, tag == "h1"))
                page.tokens.append(token)
            held.clear()
        linked = 0

    def take(raw: str) -> None:
        nonlocal linked
        if raw:
            text = unescape(raw) if "&" in raw else raw
            held.append(text)
            if top()[4]:
                linked += len(text.split())

    at = 0
    for found in _MARKUP.finditer(html):
        take(html[at : found.start()])
        at = found.end()
        tag = found[3].lower() if found[3] else ""
        if not tag:
            held.append(" ") if found[1] and held else None
            continue
        block = tag in _BLOCKS
        if block:
            end_block()
        elif tag == "br":
            held.append(" ")
        if found[2]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
                if not block and stack[k][0] in _BLOCKS:
                    break
            continue
        if block:
            k = len(stack)
            while k and stack[k - 1][0] not in _BLOCKS:
                k -= 1
            if k and stack[k - 1][0] in ("p", "li" if tag == "li" else "p", "title"):
                del stack[k - 1 :]
        _, path, article, left_out, link, named, number = top()
        name = found[4].strip() if block else ""
        here = xxhash.xxh64_intdigest(f"{tag} {name if 'class' in name else ''}", seed=path & 0xFFFFFFFF)
        if block:
            page.tokens.append(here)
        if tag in _EMPTY or found[4].endswith("/"):
            continue
        inside = article or tag in ("article", "main") or (block and 'role="main"' in found[4])
        said = _marked(tag, found[4], article)
        if said in ("part", "talk"):
            named = (*named, len(marks))
            marks.append(said)
        if inside and number < 0:
            number = len(articles)
            articles.append(() if left_out else named)
        stack.append((tag, here if block else path, inside, left_out or said == "fixed", link or tag == "a", named, number))
    take(html[at:])
    end_block()
    _leave_out(page, marks, articles, heads)
    return page


def same_page(html: str, page: Page) -> int:
    """Equal for copies of a page: a hash of its longest block, of the article's where there is one, or of a short page's html."""
    blocks = [b for b in page.blocks if not b.left_out]
    blocks = [b for b in blocks if b.article] or blocks
    longest = max(blocks, key=lambda b: (b.words - b.linked, b.text), default=None)
    told = longest is not None and longest.words - longest.linked >= TELLING
    return _signed(xxhash.xxh64_intdigest(longest.text if told else html))


_TOKENS = "host string, digest bigint, token bigint, n int"


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def token_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page how often each of its tokens occurs; token 0 is the page itself."""
    for batch in batches:
        for first in range(0, len(batch), 256):
            hosts, digests, tokens, counts = [], [], [], []
            for host, html in zip(*(batch.column(k).slice(first, 256).to_pylist() for k in (0, 1)), strict=True):
                page = parse(html)
                digest = same_page(html, page)
                seen: dict[int, int] = {0: 1}
                for token in page.tokens:
                    seen[token] = seen.get(token, 0) + 1
                hosts += [host] * len(seen)
                digests += [digest] * len(seen)
                tokens += map(_signed, seen)
                counts += seen.values()
            yield pa.record_batch(
                {
                    "host": pa.array(hosts, pa.string()),
                    "digest": pa.array(digests, pa.int64()),
                    "token": pa.array(tokens, pa.int64()),
                    "n": pa.array(counts, pa.int32()),
                }
            )


def _classes(pages: DataFrame, support: float, least: int, size: int) -> DataFrame:
    """``host, class, tokens``: tokens of equal occurrence vectors on a host's different pages.

    A vector is known by the sum, over the pages, of a hash of page and count; equal pages,
    and pages of the same longest block, count once. Frequent tokens are no more than a page has, so a class is never large.
    """
    rows = pages.select("host", "html").mapInArrow(token_batches, _TOKENS)
    once = rows.groupBy("host", "token", "digest").agg(F.max("n").alias("n"))
    place = F.xxhash64("digest", "n")
    # 64-bit hashes summed as two halves, which cannot overflow
    vectors = once.groupBy("host", "token").agg(
        F.sum(F.expr("n")).alias("times"),
        F.count(F.lit(1)).alias("pages"),
        F.sum(place.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        F.sum(F.shiftrightunsigned(place, 32)).alias("high"),
    )
    vectors = vectors.filter(F.col("pages") >= least)
    whole = vectors.filter("token = 0").select("host", F.col("pages").alias("all"))
    frequent = vectors.filter("token <> 0").join(whole, "host").filter(F.col("pages") >= F.col("all") * F.lit(support))
    # tokens that occur once per page and page; others repeat within it and frame nothing
    grouped = frequent.filter(F.col("times") == F.col("pages")).groupBy("host", "pages", "low", "high")
    grouped = grouped.agg(F.sort_array(F.collect_list("token")).alias("tokens")).filter(F.size("tokens") >= size)
    return grouped.select("host", F.xxhash64("pages", "low", "high").alias("class"), "pages", "tokens")


_CHECKS = "host string, class bigint, slot int, digest_low bigint, digest_high bigint, crossed int, words bigint, linked bigint, headed int"


def _templates(pages: DataFrame, store: Scratch, support: float, least: int, size: int, running: float) -> DataFrame:
    """``host, template``: the tokens of the valid classes, those of the frame in order, and the first and last content slot."""
    classes = store.keep(_classes(pages, support, least, size), "classes")
    one = F.struct(F.col("pages"), F.col("class"), F.col("tokens"))
    # per host no more classes than frequent tokens
    by_host = classes.groupBy("host").agg(F.sort_array(F.collect_list(one), asc=False).alias("classes"))
    by_host = store.keep(by_host, "by-host")
    checks = _with_host(pages.select("host", "html"), by_host, "classes").select("host", "html", "classes")
    checks = checks.mapInArrow(check_batches, _CHECKS)
    told = checks.groupBy("host", "class", "slot").agg(
        F.min("digest_low").alias("a"),
        F.max("digest_low").alias("b"),
        F.min("digest_high").alias("c"),
        F.max("digest_high").alias("d"),
        F.max("crossed").alias("crossed"),
        F.sum("words").alias("words"),
        F.sum("linked").alias("linked"),
        F.count(F.lit(1)).alias("pages"),
        F.max("headed").alias("headed"),
    )
    told = store.keep(told, "checks")
    valid = told.filter("slot = -1 AND a = b AND c = d AND crossed = 0").select("host", "class")
    tokens = classes.join(valid, ["host", "class"]).groupBy("host").agg(
        F.sort_array(F.collect_list(F.struct("pages", "class", "tokens")), asc=False).alias("classes")
    )
    runs = (F.col("words") - F.col("linked")) >= F.lit(running) * F.col("pages")
    slots = told.filter("slot >= 0").select("host", "class", "slot", runs.alias("runs"), (F.col("headed") > 0).alias("headed"))
    best = slots.groupBy("host", "class").agg(
        F.min(F.when(F.col("runs") | F.col("headed"), F.col("slot"))).alias("first"), F.max(F.when(F.col("runs"), F.col("slot"))).alias("last")
    )
    best = best.filter("last IS NOT NULL").select("host", "class", F.array("first", "last").alias("slots"))
    frame = tokens.select("host", "classes", F.col("classes")[0]["class"].alias("class"))
    joined = frame.join(best, ["host", "class"], "left")
    return joined.select("host", F.struct("classes", "slots").alias("template"))


def _with_host(pages: DataFrame, by_host: DataFrame, name: str) -> DataFrame:
    # a host's row holds all its frequent tokens, so hosts are no measure
    told = by_host.agg(F.sum(F.length(F.to_json(name)) + F.length("host"))).first()[0] or 0
    small = told <= BROADCAST_BYTES
    other = by_host.select(F.col("host").alias("_host"), name)
    return pages.join(F.broadcast(other) if small else other, pages["host"] == F.col("_host"), "left")


def _frame(classes: list[dict]) -> set[int]:
    """Tokens of the largest, most frequent class: the outermost frame."""
    return set(classes[0]["tokens"]) if classes else set()


def _slots(page: Page, frame: set[int]) -> list[int]:
    """Each block's slot: how many of the frame's tokens stand before it."""
    passed = np.cumsum([0] + [_signed(t) in frame for t in page.tokens])
    return [int(passed[b.after]) for b in page.blocks]


def check_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page and class the order of its tokens and whether it crosses a class above it; per slot of the frame its words."""
    for batch in batches:
        out: list[tuple] = []
        for host, html, classes in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if not classes:
                continue
            page = parse(html)
            places: dict[int, int] = {}
            for place, token in enumerate(page.tokens):
                places.setdefault(_signed(token), place)
            spans: list[list[int]] = []
            for entry in classes:
                held = sorted((places[t], t) for t in entry["tokens"] if t in places)
                if len(held) < len(entry["tokens"]):
                    continue
                digest = xxhash.xxh64_intdigest(np.array([t for _, t in held], dtype=np.int64).tobytes())
                own = [p for p, _ in held]
                # nested: between two neighbouring tokens of every class above it, or around all of it
                crossed = any(
                    len({np.searchsorted(above, p) for p in own}) > 1 and not own[0] < above[0] <= above[-1] < own[-1] for above in spans
                )
                spans.append(own)
                out.append((host, entry["class"], -1, digest & 0xFFFFFFFF, digest >> 32, int(crossed), 0, 0, 0))
            frame = _frame(classes)
            sums: dict[int, list[int]] = {}
            # the frame's own text fills no slot
            for block, slot in zip(page.blocks, _slots(page, frame), strict=True):
                if not block.left_out and _signed(block.token) not in frame:
                    held_words = sums.setdefault(slot, [0, 0, 0])
                    held_words[0] += block.words
                    held_words[1] += block.linked
                    held_words[2] |= block.heading and 2 * block.linked <= block.words
            out += [(host, classes[0]["class"], slot, 0, 0, 0, w, k, int(h)) for slot, (w, k, h) in sums.items()]
        names = [c.split()[0] for c in _CHECKS.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        yield pa.record_batch({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})


def main_text(html: str, template: dict | None) -> str:
    """The page's content blocks, one a line."""
    page = parse(html)
    classes = (template or {}).get("classes") or []
    fixed = {t for entry in classes for t in entry["tokens"]}
    blocks = [b for b in page.blocks if not b.left_out]
    if any(b.article for b in blocks):
        return "\n".join(b.text for b in blocks if b.article)
    slots = (template or {}).get("slots")
    if slots:
        where = dict(zip((id(b) for b in page.blocks), _slots(page, _frame(classes)), strict=True))
        blocks = [b for b in blocks if slots[0] <= where[id(b)] <= slots[1]]
    blocks = [b for b in blocks if _signed(b.token) not in fixed]
    # blocks of links are lists of sources between running text, menus elsewhere
    runs = [k for k, b in enumerate(blocks) if b.words - b.linked >= RUNNING and 2 * b.linked <= b.words]
    inside = range(runs[0], runs[-1] + 1) if runs else range(0)
    return "\n".join(b.text for k, b in enumerate(blocks) if k in inside or 2 * b.linked <= b.words)


def host_of(url: Column) -> Column:
    """The host in lower case; empty without one."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def extract_pages(
    pages: DataFrame, support: float = SUPPORT, least: int = PAGES, size: int = SIZE, running: float = RUNNING
) -> DataFrame:
    """Per page ``page_id, url, text, n_chars``: the main text, its blocks one a line.

    Defined cases: a null or empty html has an empty text. Pages without a host are pages
    of one host, the empty one. Repeated rows are rows like any other; copies of a page,
    known by its longest block, count once in their host's template. An empty table gives an empty result. Other columns
    are not read.
    """
    store = Scratch(pages.sparkSession, "extraction")
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), host_of(F.col("url")).alias("host"))
    templates = store.keep(_templates(rows, store, support, least, size, running), "templates")
    store.keep_only("templates")
    met = _with_host(rows, templates, "template").select("page_id", "url", "html", "template")
    kinds = dict(pages.dtypes)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, t) for h, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.record_batch(
                {
                    "page_id": batch.column(0),
                    "url": batch.column(1),
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                }
            )

    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint"
    return met.mapInArrow(extracted, schema)
