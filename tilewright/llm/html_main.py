"""Main text of web pages: site templates are found by counting subtrees per host and cut away.

A page is read once into a flat list of events (text, block edges) in which each element covers a range. Elements that by
themselves are no article text (nav, footer, form, script, ...) are dropped on any page, so a
host with few pages is clean too; so are containers with a role of that kind, or with a class or id that as a whole is one of a few words for menus,
headers, footers, sidebars, notices, adverts and reader comments (MARKS). An article, its running text and inline elements are never dropped for their class.

Every element's subtree is hashed from its tag, its text and its children's hashes, once, when it closes. Spark counts, per host, the pages on which each container's hash
occurs (a page once), and the different main texts of these pages of which the subtree is less than two thirds, and less than half. A subtree that only occurs in one larger subtree stands or falls with that. Only one with ``min_pages`` of the former can be a template, so the
article that a host serves under several addresses is none. It is one, and is cut from the host's pages, if it is on ``min_share`` of them; or, as that of a section or a rotating
advert, if it has ``min_pages`` of the latter, and these are ``section_share`` of the host's pages or ``enough`` however many it has. Inside an article or main element running text, lists and tables are
no template (a paragraph that many pages quote, ingredients that recipes share), while boxes may be. What is left of main or article elements, or else of the
body, is the main text: a line per block. A page of which templates would leave nothing keeps what it has.

The template table goes to workers as a broadcast only if it is counted to be at most ``BROADCAST`` rows; beyond,
each host's templates are joined to its pages by shuffle, where adaptive execution splits a hot host.

Defined results: null and empty html give empty text; null urls or such without ``://`` are one host; broken markup
is read as far as it goes (unclosed elements end with their parent, unknown ends are ignored, a tag with an odd quote ends at the
next ``>``); U+0000 is text; repeated rows count as pages and get a row each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import groups, ship
from tilewright.llm.url_filters import url_host
from tilewright.session import materialize

#: Template rows (host and hash, some 60 bytes each) that may be broadcast.
BROADCAST = 100_000
COUNTED = 200_000
#: In the place of a parent's hash: none.
OUTSIDE = -(1 << 63)

# HTML elements by their role.
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noframes noembed iframe xmp".split())
DROPPED = set("head script style noscript template textarea title nav footer aside form button select option input iframe object svg canvas menu dialog search noframes noembed audio video map".split())
CONTAINERS = set("div section ul ol dl table aside figure header details center fieldset".split())
LISTS = set("ul ol dl table figure".split())
RUNNING = set("p li blockquote pre h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCKS - {"body", "head", "html", "option", "optgroup", "legend", "caption", "title", "td", "th", "tr", "tbody", "thead", "tfoot"}
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
# Whole classes or ids that name what the main text is without, and roles of the same kind.
MARKS = set("""
menu nav navbar navigation main-nav top-nav site-nav breadcrumb breadcrumbs pagination
site-header page-header masthead
footer site-footer page-footer
sidebar side-bar left-sidebar right-sidebar
notice notices cookie-notice cookie-banner cookie-consent cookies consent privacy-notice
ad ads advert adverts advertisement advertisements advertising sponsored ad-banner banner-ad
comments comment comment-list comment-section comments-area reader-comments disqus_thread
""".split())
ROLES = set("navigation contentinfo complementary search dialog alertdialog menu menubar".split())
MARKED = set("div section ul ol dl table center details fieldset".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+>|[^>]*>?)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
HIDDEN = re.compile(r"display\s*:\s*none", re.I)
#: A block's edge among the events.
EDGE = None


@dataclass(frozen=True)
class Template:
    """When a subtree is a host's template: part of so many different texts, and on such a share of the host's pages; for a small part a smaller share of texts, or enough of them, will do."""

    min_pages: int = 5
    min_share: float = 0.5
    section_share: float = 0.01
    enough: int = 50


def attributes(text: str) -> dict[str, str]:
    """Names in lower case -> values; the first of equal names counts."""
    out: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), unescape("".join(values)))
    return out


def is_marked(tag: str, found: dict[str, str], in_main: bool) -> bool:
    """Whether an element's attributes say that it is no article text."""
    if tag in ("html", "body", "main", "article"):
        return False
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or HIDDEN.search(found.get("style", "")):
        return True
    if tag not in MARKED:
        return False
    role = found.get("role", "").lower()
    words = set(f"{found.get('class', '')} {found.get('id', '')}".lower().split())
    return role in ROLES or bool(words & MARKS) or not in_main and ("header" in words or role == "banner")


class Page:
    """Events of a page and the ranges of its elements: dropped ones, main ones, and, if hashed, the parts a template may be: hash, characters, range."""

    def __init__(self, html: str, hashed: bool = False):
        self.events: list[str | None] = []
        self.dropped: list[tuple[int, int]] = []
        self.main: list[tuple[str, int, int]] = []
        self.parts: list[tuple[int, int, int, int]] = []
        # tag, first event, dropped here, inside dropped, inside main, what its subtree holds, characters
        stack: list[list] = []
        events = self.events
        at = 0

        def close(n: int) -> None:
            while len(stack) > n:
                tag, start, here, inside, in_main, items, size = stack.pop()
                if tag in BLOCKS:
                    events.append(EDGE)
                end = len(events)
                if here and not inside:
                    self.dropped.append((start, end))
                elif not here and not inside and tag in ("main", "article"):
                    self.main.append((tag, start, end))
                if not size:
                    continue
                key = xxhash.xxh64_intdigest("\x1f".join((tag, *items))) - (1 << 63)
                if stack:
                    stack[-1][5].append(f"\x1e{key:x}")
                    stack[-1][6] += size
                if not inside and (tag in CONTAINERS and not (in_main and tag in LISTS) or here and tag in BLOCKS or tag in RUNNING and not in_main):
                    self.parts.append((key, size, start, end))

        def depth(of: set[str], until: set[str] = frozenset()) -> int:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in of:
                    return i
                if stack[i][0] in until:
                    break
            return -1

        find = TOKEN.search
        while True:
            m = find(html, at)
            text = html[at : m.start() if m else len(html)]
            if text:
                if "&" in text:
                    text = unescape(text)
                events.append(text)
                if hashed and stack and stack[-1][0] not in RAW and (plain := " ".join(text.split())):
                    stack[-1][5].append(plain)
                    stack[-1][6] += len(plain)
            if not m:
                break
            at = m.end()
            tag = m[2]
            if not tag:
                continue
            tag = tag.lower()
            if m[1]:
                if (i := depth({tag})) >= 0:
                    close(i)
                elif tag == "p":
                    events.append(EDGE)
                continue
            if tag in VOID:
                events.append(EDGE if tag == "hr" else " " if tag == "br" else "")
                continue
            if tag in CLOSES_P and (i := depth({"p"}, {"table", "td", "div", "section", "article"})) >= 0:
                close(i)
            elif tag in CLOSES and (i := depth(*CLOSES[tag])) >= 0:
                close(i)
            above = stack[-1] if stack else None
            in_main = bool(above and above[4])
            found = attributes(m[3].removesuffix(">")) if "=" in m[3] or "hidden" in m[3] else {}
            main = tag in ("main", "article") or found.get("role", "").lower() == "main"
            here = tag in DROPPED or bool(found) and not main and is_marked(tag, found, in_main) or tag == "header" and not in_main
            start = len(events)
            if tag in BLOCKS:
                events.append(EDGE)
            if tag in RAW:
                end = re.compile(f"</{tag}", re.I).search(html, at)
                at = end.start() if end else len(html)
            stack.append(["main" if main and tag != "article" else tag, start, here, bool(above and (above[2] or above[3])), main or in_main, [], 0])
        close(0)

    def parents(self) -> Iterator[tuple[int, int | None]]:
        """Each part's hash and that of the least part around it."""
        around: list[tuple[int, int, int]] = []
        for key, _, start, end in reversed(self.parts):
            while around and not (around[-1][1] <= start and end <= around[-1][2]):
                around.pop()
            yield key, around[-1][0] if around else None
            around.append((key, start, end))

    def text(self, templates: frozenset[int] | set[int] = frozenset()) -> str:
        """Blocks of the main text, one a line. templates: hashes to cut, for a page that is hashed, unless nothing would be left."""
        return self._shown(templates) or (self._shown(frozenset()) if templates else "")

    def _shown(self, templates: frozenset[int] | set[int]) -> str:
        cut = self.dropped + [(start, end) for key, _, start, end in self.parts if key in templates]
        keep = [(s, e) for tag, s, e in self.main if tag == "main"] or [(s, e) for _, s, e in self.main] or [(0, len(self.events))]
        shown = bytearray(len(self.events))
        for s, e in keep:
            shown[s:e] = b"\1" * (e - s)
        for s, e in cut:
            shown[s:e] = b"\0" * (e - s)
        blocks: list[list[str]] = [[]]
        for x, on in zip(self.events, shown):
            if x is EDGE:
                blocks.append([])
            elif on:
                blocks[-1].append(x)
        lines = (" ".join("".join(b).split()) for b in blocks if b)
        return "\n".join(line for line in lines if line)


def subtree_counts(pages: DataFrame) -> DataFrame:
    """pages(host, html) -> host, hash, n, around, apart, within: pages of the host with the subtree, different main texts of which it is less than two thirds and less than half, and whether it only occurs in one larger subtree; hash null: all its pages."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        inside: dict[tuple, tuple] = {}

        def hand_on() -> pa.RecordBatch:
            keys = list(seen)
            ends = [inside.get(k[:2], (None, None)) for k in keys]
            out = [pa.array([k[0] for k in keys], pa.string()), *(pa.array([k[i] for k in keys], pa.int64()) for i in (1, 2)), pa.array([k[3] for k in keys], pa.bool_()), pa.array([seen[k] for k in keys], pa.int64()), *(pa.array([e[i] for e in ends], pa.int64()) for i in (0, 1))]
            seen.clear()
            inside.clear()
            return pa.RecordBatch.from_arrays(out, ["host", "hash", "body", "small", "n", "low", "high"])

        for batch in groups(batches, "html"):
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[host, None, None, False] += 1
                page = Page(html or "", hashed=True)
                text = page.text()
                body = xxhash.xxh64_intdigest(text) - (1 << 63)
                for key, size in {key: size for key, size, _, _ in page.parts}.items():
                    seen[host, key, body if 3 * size < 2 * len(text) else None, 2 * size < len(text)] += 1
                for key, parent in page.parents():
                    parent = OUTSIDE if parent is None else parent
                    low, high = inside.get((host, key), (parent, parent))
                    inside[host, key] = min(low, parent), max(high, parent)
                if len(seen) > COUNTED:
                    yield hand_on()
        yield hand_on()

    rows = pages.select("host", "html").mapInArrow(run, "host string, hash long, body long, small boolean, n long, low long, high long")
    parents = F.min("low").alias("low"), F.max("high").alias("high")
    once = rows.groupBy("host", "hash", "body", "small").agg(F.sum("n").alias("n"), *parents)
    counted = once.groupBy("host", "hash").agg(F.sum("n").alias("n"), F.count("body").alias("around"), F.count(F.when(F.col("small"), F.col("body"))).alias("apart"), *parents)
    return counted.withColumn("within", F.coalesce((F.col("low") == F.col("high")) & (F.col("low") != OUTSIDE), F.lit(False))).drop("low", "high")


def site_templates(pages: DataFrame, t: Template = Template()) -> DataFrame:
    """pages(host, html) -> host, hash of the subtrees that are a host's template."""
    counts = materialize(subtree_counts(pages).where((F.col("n") >= t.min_pages) | F.col("hash").isNull()), "subtrees")
    of_host = counts.where("hash is null").select("host", F.col("n").alias("pages"))
    often = F.col("n") >= t.min_share * F.col("pages")
    section = (F.col("apart") >= t.min_pages) & (F.col("apart") >= F.least(t.section_share * F.col("pages"), F.lit(float(t.enough))))
    return counts.where(F.col("hash").isNotNull() & (F.col("around") >= t.min_pages) & ~F.col("within")).join(of_host, "host").where(often | section).select("host", "hash")


def main_text(pages: DataFrame, t: Template = Template(), broadcast_rows: int = BROADCAST) -> DataFrame:
    """pages(page_id, url, html) -> page_id, url, text, n_chars."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.col("html").cast("string").alias("html"), url_host(F.col("url")).alias("host"))
    rows = rows.withColumn("host", F.coalesce("host", F.lit("")))
    templates = materialize(site_templates(rows, t), "templates")
    schema = "page_id long, url string, text string, n_chars long"

    def texts(batch: pa.RecordBatch, of: Iterator[set[int]]) -> pa.RecordBatch:
        found = [Page(html or "", hashed=bool(cut)).text(cut) for html, cut in zip(batch.column(2).to_pylist(), of)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())], ["page_id", "url", "text", "n_chars"])

    if templates.count() <= broadcast_rows:
        by_host: dict[str, set[int]] = {}
        for r in templates.collect():  # at most broadcast_rows
            by_host.setdefault(r.host, set()).add(r.hash)
        shared = pages.sparkSession.sparkContext.broadcast(by_host)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in groups(batches, "html"):
                yield texts(batch, (shared.value.get(h, ()) for h in batch.column(3).to_pylist()))

        return rows.select("page_id", "url", "html", "host").mapInArrow(run, schema)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches, "html"):
            yield texts(batch, (set(x or ()) for x in batch.column(3).to_pylist()))

    lists = materialize(templates.groupBy("host").agg(F.collect_set("hash").alias("hashes")), "host-templates")
    return rows.join(lists, "host", "left").select("page_id", "url", "html", "hashes").mapInArrow(joined, schema)
