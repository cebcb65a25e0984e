"""Main text of web pages by template deduction from equivalence classes.

Pages of one host come from templates. A page is read as a row of tokens: its structural elements, told
apart by their path (names, ids and classes from the root), and the texts outside of the article, told
apart by path and content. Tokens that occur equally often on each page of a host share an occurrence
vector and form an equivalence class. Vectors are compared by a fingerprint that adds up over pages, so
no page ever meets another: one row per host and token is shuffled.

A class is valid if it has a support of at least ``SUPPORT`` pages and one in ``SHARE``, its tokens come in the same order
in each of its rounds, and on all pages all of its rounds lie in the same gap between two tokens of another
class, or in none; a class that straddles the tokens of the one around it is not valid. The tokens of valid classes
belong to the template. What the template leaves open are its slots, and their content is extracted in page order:

* elements that a page is known by its mark-up to keep beside the article (menus, headers, footers,
  sidebars, notices, adverts, forms, scripts, styles, reader comments) are no slots;
* where a page has an ``article`` or ``main`` element, its slots are those inside of it, with all text;
* else they are all others, without the texts that are part of the template.

A page of a host with too few pages has no template, and nothing is taken from its text. NULL is an empty page.
Pages are read whole; broken mark-up closes what it leaves open at the end of the enclosing element.
Repeated rows are pages of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.common import bound_batches, keep_row, pieces
from pulsetrail.workspace import stage

SUPPORT = 3
# A template's tokens are on at least one page in so many of a host, which bounds their number.
SHARE = 100
MASK = (1 << 64) - 1

# Elements that build up a page; others are inline, blocks of text or end by themselves.
STRUCTURE = frozenset(
    "html head body nav header footer aside form div section article main ul ol dl table menu figure dialog details select button template noscript iframe svg canvas object".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that are never part of the article; a header may be one's own.
BESIDE = frozenset("head nav aside form menu dialog select button template noscript iframe svg canvas object footer".split())
# Words in an id or class or a role that say the same of any element, and an article inside of it is none.
MARKS = frozenset(
    """ad ads advert adverts advertisement advertising sponsor sponsored promo promotion
    comment comments reply replies respond disqus related recommended recommendations share sharing social""".split()
)
# The same, but for elements around an article.
AROUND = frozenset(
    """banner nav navbar navigation menu breadcrumb breadcrumbs pagination pager skip footer foot colophon copyright
    sidebar aside rail widget widgets cookie cookies consent gdpr notice notices alert popup modal overlay
    newsletter subscribe signup form search login complementary contentinfo""".split()
)
# The same, but for elements in an article.
HEADERS = frozenset("header masthead topbar".split())
RAW = frozenset(["script", "style", "textarea", "title", "xmp", "noembed", "noframes"])
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
ARTICLE = frozenset(["article", "main"])
# How sure an element is beside the article.
NO, MAYBE, YES = range(3)

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)
    |<(/?)([a-zA-Z][^\s/>]*)((?:=\s*[^\s"'>][^\s>]*|[^>"']|"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)""",
    re.DOTALL | re.VERBOSE,
)
_ATTRIBUTE = re.compile(r"(id|class|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_PARTS = re.compile(r"[a-z]+")


class Page:
    """One page as structural tokens and blocks of text."""

    def __init__(self, source: str):
        self.tokens: list[int] = [0]  # in page order, first the page itself
        self.blocks: list[tuple[str, bool, int]] = []  # text, inside an article, its token
        self.has_article = False
        self._open: list[tuple[str, int, int, bool]] = []  # name, path, beside, inside
        self._text: list[str] = []
        at = 0
        while at < len(source):
            found = _TOKEN.search(source, at)
            if not found:
                self._text.append(source[at:])
                break
            self._text.append(source[at : found.start()])
            at = found.end()
            if not found[2]:
                continue
            name = found[2].lower()
            if found[1]:
                self._close(name)
                continue
            if name in RAW and not found[3].endswith("/"):
                end = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>", re.IGNORECASE).search(source, at)
                self._block()
                at = end.end() if end else len(source)
                continue
            self._start(name, found[3])
        self._block()

    def _state(self) -> tuple[int, int, bool]:
        return self._open[-1][1:] if self._open else (0, NO, False)

    def _start(self, name: str, attributes: str) -> None:
        if name in INLINE:
            return
        self._block()
        if name in VOID or attributes.endswith("/"):
            return
        if name == "body":
            self._close("head")
        if self._open and self._open[-1][0] == "p":
            self._open.pop()
        path, beside, inside = self._state()
        known = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if "=" in attributes else {}
        words = {part for value in known.values() for part in _PARTS.findall(value.lower())}
        own = NO
        if name in BESIDE or name not in ("html", "body") and words & MARKS:
            own = YES
        elif name not in ("html", "body") and (words & AROUND or not inside and (words & HEADERS or name == "header")):
            own = MAYBE
        if name not in STRUCTURE and own == NO:
            return
        if name in ARTICLE and own == NO and beside < YES:
            inside, beside = True, NO
        beside = max(beside, own)
        self.has_article |= inside
        path = xxhash.xxh3_64_intdigest(f"{path} {name} {known.get('id', '')} {known.get('class', '')}")
        self.tokens.append(path)
        self._open.append((name, path, beside, inside))

    def _close(self, name: str) -> None:
        if name in INLINE:
            return
        self._block()
        for depth in range(len(self._open) - 1, -1, -1):
            if self._open[depth][0] == name:
                del self._open[depth:]
                return

    def _block(self) -> None:
        """End the block of text at work."""
        text = " ".join(html.unescape("".join(self._text)).split())
        self._text.clear()
        path, beside, inside = self._state()
        if text and beside == NO:
            token = 0
            if not inside:
                token = xxhash.xxh3_64_intdigest(text, seed=path & 0xFFFFFFFF)
                self.tokens.append(token)
            self.blocks.append((text, inside, token))

    def text(self, template: Sequence[int] = ()) -> str:
        """The main text; blocks that are part of the ``template`` are left out beside an article."""
        if self.has_article:
            return " ".join(text for text, inside, _ in self.blocks if inside)
        return " ".join(text for text, _, token in self.blocks if token not in template)


def deduce_templates(pages: DataFrame) -> DataFrame:
    """The tokens of each host's template: host, class (its smallest token), parent and gap (the class it lies in and
    after how many of its tokens, or NULL), token.

    ``pages`` has host, key and html. The first pass adds up occurrence vectors, the second checks that
    the tokens of each class keep their order and that classes nest.
    """

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            rows: dict[tuple[str, int], list[int]] = {}
            for host, key, source in zip(*[batch.column(c).to_pylist() for c in ("host", "key", "html")]):
                counts: dict[int, int] = {}
                for token in Page(source).tokens:
                    counts[token] = counts.get(token, 0) + 1
                for token, count in counts.items():
                    vector = xxhash.xxh3_64_intdigest(f"{key}:{count}")
                    row = rows.setdefault((host, token), [0, 0])
                    row[0] ^= vector
                    row[1] += 1
            if rows:
                signed = lambda v: pa.array(np.array(v, np.uint64).view(np.int64))
                arrays = [
                    pa.array([h for h, _ in rows], pa.string()),
                    signed([t for _, t in rows]),
                    signed([v for v, _ in rows.values()]),
                    pa.array([n for _, n in rows.values()], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["host", "token", "vector", "pages"])

    seen = pages.mapInArrow(occurrences, "host string, token bigint, vector bigint, pages bigint")
    vectors = seen.groupBy("host", "token").agg(F.bit_xor("vector").alias("vector"), F.sum("pages").alias("support"))
    known = stage(vectors.filter(F.col("support") >= SUPPORT), "html-vectors")
    hosts = known.filter("token = 0").select("host", F.col("support").alias("pages"))
    known = known.join(hosts, "host").filter(F.col("support") * SHARE >= F.col("pages"))
    classes = known.groupBy("host", "vector", "support").agg(F.collect_set("token").alias("tokens"))
    by_host = classes.filter(F.size("tokens") > 1).groupBy("host").agg(F.collect_list("tokens").alias("classes"))
    by_host = stage(by_host, "html-classes")

    def orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            out: dict[tuple[str, int], list[int]] = {}
            for host, source, classes in zip(*[batch.column(c).to_pylist() for c in ("host", "html", "classes")]):
                of = {t & MASK: min(tokens) for tokens in classes for t in tokens}
                sizes = {min(tokens): len(tokens) for tokens in classes}
                for number, found in nested([t for t in Page(source).tokens if t in of], of, sizes).items():
                    order, parent, gap = found or (-1, 0, 0)
                    row = out.setdefault((host, number), [order, order, parent, gap, True])
                    row[:2] = min(row[0], order), max(row[1], order)
                    row[4] &= order >= 0 and row[2:4] == [parent, gap]
            if out:
                values = list(out.values())
                kinds = [pa.int64()] * 4 + [pa.bool_()]
                arrays = [pa.array([h for h, _ in out], pa.string()), pa.array([n for _, n in out], pa.int64()), *map(pa.array, zip(*values), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, ["host", "class", "low", "high", "parent", "gap", "sure"])

    checked = pages.join(by_host, "host").select("host", "html", "classes")
    checked = checked.mapInArrow(orders, "host string, class bigint, low bigint, high bigint, parent bigint, gap bigint, sure boolean")
    place = F.struct("parent", "gap")
    checked = checked.groupBy("host", "class").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.min(place).alias("place"), F.max(place).alias("other"), F.min("sure").alias("sure")
    )
    ordered = checked.filter("sure AND low = high AND place = other")
    ordered = ordered.select("host", "class", *[F.when(F.col("place.gap") > 0, F.col(f"place.{c}")).alias(c) for c in ("parent", "gap")])
    named = by_host.select("host", F.explode("classes").alias("tokens"))
    named = named.select("host", F.array_min("tokens").alias("class"), F.explode("tokens").alias("token"))
    return named.join(ordered, ["host", "class"]).select("host", "class", "parent", "gap", "token")


def nested(tokens: Sequence[int], of: dict[int, int], sizes: dict[int, int]) -> dict[int, tuple[int, int, int] | None]:
    """For each class on a page a number of its order, the class around it and after how many of that one's
    tokens it comes (0, 0: around it is none); None if its rounds differ in these or it straddles another.

    ``tokens`` are those of classes, ``of`` names the class of each and ``sizes`` how many it has.
    """
    orders: dict[int, list[int]] = {}
    places: dict[int, tuple[int, int]] = {}
    broken: set[int] = set()
    open_: list[list[int]] = []  # class, tokens seen of this round
    for token in tokens:
        number = of[token]
        if number in broken:
            continue
        depth = next((d for d in range(len(open_) - 1, -1, -1) if open_[d][0] == number), None)
        if depth is None:
            place = tuple(open_[-1]) if open_ else (0, 0)
            depth = len(open_)
            open_.append([number, 0])
            if places.setdefault(number, place) != place:
                broken.add(number)
        # What is open within and not at its end straddles this token.
        broken.update(inner for inner, _ in open_[depth + 1 :])
        del open_[depth + 1 :]
        order, seen = orders.setdefault(number, []), open_[depth][1]
        if len(order) == seen < sizes[number]:
            order.append(token)
        if order[seen] != token:
            broken.add(number)
        open_[depth][1] += 1
        if number in broken or open_[depth][1] == sizes[number]:
            open_.pop()
    broken.update(number for number, _ in open_)
    number_of = lambda order: xxhash.xxh3_64_intdigest(np.array(order, np.uint64).tobytes()) >> 1
    return {n: None if n in broken else (number_of(order), *places[n]) for n, order in orders.items()}


def main_text(df: DataFrame, *, url: str = "url", source: str = "html", carry: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``df`` as ``_row`` (of its columns those in ``carry``, or all) with their main ``text``."""
    page = F.coalesce(F.col(source), F.lit(""))
    hosts = F.coalesce(F.regexp_extract(F.lower(F.col(url)), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))
    pages = bound_batches(df).select(hosts.alias("host"), F.xxhash64(url, source).alias("key"), page.alias("html"))
    templates = deduce_templates(pages).groupBy("host").agg(F.collect_set("token").alias("template"))
    templates = stage(templates, "html-templates")
    rows = keep_row(df, hosts.alias("host"), page.alias("html"), carry=carry)
    known = rows.join(templates, "host", "left").select("html", "template", "_row")
    schema = f"text string, _row {rows.schema['_row'].dataType.simpleString()}"

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            found = []
            for source, template in zip(batch.column("html").to_pylist(), batch.column("template").to_pylist()):
                found.append(Page(source).text({t & MASK for t in template or ()}))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), batch.column("_row")], ["text", "_row"])

    return known.mapInArrow(extract, schema)
