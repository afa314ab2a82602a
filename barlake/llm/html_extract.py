"""Main text of web pages by tree scoring.

Each page becomes a tree of its elements.  Paragraphs earn points for their
length and commas and pass them to their ancestors, less with each level; an
element's points are discounted by the share of its text that stands in links.
The best element is the container of the article: it is kept whole, with those
siblings that score near it or read like prose.  Elements that are never
article text (menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles, comments) are left out before, by tag, role or class name, and
lists that are mostly links after.

A page is one row and its tree lives only while that row is read: pages need
no shuffle, and Arrow batches are cut by bytes.
"""

from __future__ import annotations

import html as _html
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .blocks import sized_batches
from .common import free_name, query, read_table

BATCH_BYTES = 16 << 20
FULL_PARAGRAPH = 25         # characters from which a paragraph earns its whole point
POINT_CHARS = 100           # characters worth a point, up to MAX_LENGTH_POINTS
MAX_LENGTH_POINTS = 3
LEVELS = 5                  # ancestors that get points
SIBLING_SHARE = 0.2         # of the container's score, and SIBLING_LEAST at least, for a sibling to be kept
SIBLING_LEAST = 10
PROSE_CHARS = 80            # a longer paragraph beside the container is kept if few of it are links
PROSE_LINKS = 0.25
MENU_LINKS = 0.5            # lists and boxes with a larger share of link text, in MENU_LEAST links or more, are menus
MENU_LEAST = 3
NAMED = 25                  # points for a name or tag that says "article"

# Elements of HTML by how they behave.
_VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q rb rp rt rtc ruby s samp small
span strike strong sub sup time tt u var""".split())
_CLOSES_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
header hgroup hr main menu nav ol p pre search section summary table ul li dd dt""".split())
_SCOPES = {"p": ("table", "td", "th", "caption", "button", "object"), "li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",),
           "td": ("table",), "th": ("table",), "tr": ("table",), "option": ("select",)}
_ENDS = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "option": ("option",)}
_PARAGRAPH = frozenset("p pre li dd dt h1 h2 h3 h4 h5 h6 blockquote td th figcaption".split())
_BASE = {"div": 5, "pre": 3, "td": 3, "blockquote": 3, "address": -3, "ol": -3, "ul": -3, "dl": -3, "dd": -3, "dt": -3, "li": -3, "form": -3,
         "h1": -5, "h2": -5, "h3": -5, "h4": -5, "h5": -5, "h6": -5, "th": -5, "article": NAMED, "main": NAMED}
_LEFT_OUT = frozenset("""nav menu header footer aside form noscript template svg button select option datalist object embed applet canvas audio video
dialog map fieldset search script style textarea title iframe noembed noframes""".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form note".split())
_NEGATIVE = frozenset("""ad ads adv advert adverts advertisement advertisements advertising adsbygoogle adsense adslot adunit sponsor sponsored sponsors
promo promos promoted promotion banner nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside rail header masthead topbar
footer foot comment comments commentlist disqus reply replies respond discussion cookie cookies consent gdpr notice notices alert alerts popup modal
overlay lightbox dialog share sharing sharebar social related recommended recommendations widget widgets newsletter subscribe subscription signup
login search pagination pager toolbar outbrain taboola skip paywall disclaimer""".split())
_POSITIVE = frozenset("article articlebody body content entry hentry main post story text blog prose".split())
_NOT = frozenset(("no", "has", "with", "without", "hide"))

_TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|))*+)(>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_COMMAS = re.compile("[,،、，]")
_PROSE_END = re.compile(r"[.!?…。！？][\"'”’»)]*$")


def _left_out(tag: str, attributes: str) -> tuple[bool, bool, bool]:
    """(never article text, only unless it holds the page's heading or main part, named like an article)."""
    if not attributes or attributes.isspace():
        return tag in _LEFT_OUT and tag != "form", tag == "form", False
    a = {}
    for m in _ATTRIBUTE.finditer(attributes):
        a.setdefault(m[1].lower(), _html.unescape(m[2] or m[3] or m[4] or ""))
    hidden = "hidden" in a or a.get("aria-hidden", "").lower() == "true" or "display:none" in a.get("style", "").replace(" ", "").lower()
    names = [x.lower() for x in _NAME.findall(a.get("class", "") + " " + a.get("id", ""))]
    negative = any(x in _NEGATIVE and not (i and names[i - 1] in _NOT) for i, x in enumerate(names))
    positive = a.get("role") == "main" or a.get("itemprop", "").lower() == "articlebody" or any(x in _POSITIVE for x in names)
    hard = hidden or a.get("role", "").lower() in _ROLES or (tag in _LEFT_OUT and tag != "form")
    return hard, tag == "form" or negative and tag != "main", positive


class _Tree:
    """Elements of a page in page order (a parent before its children) and its text as (element, text) chunks."""

    def __init__(self, page: str):
        self.tag, self.parent, self.hard, self.soft, self.good = ["body"], [-1], [False], [False], [False]
        self.links = [0]                             # links that start in the element itself
        self.chunks: list[tuple[int, str, bool]] = []
        self._read(page)

    def _read(self, page: str) -> None:
        tag, chunks = self.tag, self.chunks
        stack, blocks, at = [0], [0], {}            # open elements; places of block elements among them; places by tag

        def pop_to(place: int) -> None:
            while len(stack) > place:
                t = tag[stack.pop()]
                at[t].pop()
                if blocks[-1] == len(stack):
                    blocks.pop()
                    chunks.append((-1, " ", False))

        pos, end = 0, len(page)
        while pos < end:
            m = _TOKEN.search(page, pos)
            start = m.start() if m else end
            if start > pos:
                chunks.append((stack[-1], page[pos:start], bool(at.get("a"))))
            if not m:
                break
            pos = m.end()
            name = m[2]
            if not name:
                continue
            if not m[4]:                             # the page ends inside a tag
                break
            name = name.lower()
            if name in ("html", "head", "body"):
                continue
            if m[1]:
                places = at.get(name)
                if name == "br":
                    chunks.append((-1, " ", False))
                elif places and (name not in _INLINE or places[-1] > blocks[-1]):
                    pop_to(places[-1])
                continue
            if name in _VOID:
                if name in ("br", "hr"):
                    chunks.append((-1, " ", False))
                continue
            if name in _RAW:
                close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, pos)
                if close is None:
                    break
                pos = close.start()
                end_tag = page.find(">", pos)
                pos = end if end_tag < 0 else end_tag + 1
                continue
            if name in _CLOSES_P and at.get("p"):
                if all(not at.get(s) or at[s][-1] < at["p"][-1] for s in _SCOPES["p"]):
                    pop_to(at["p"][-1])
            for other in _ENDS.get(name, ()):
                places = at.get(other)
                if places and all(not at.get(s) or at[s][-1] < places[-1] for s in _SCOPES[other]):
                    pop_to(places[-1])
            if name == "a" and at.get("a") and at["a"][-1] > blocks[-1]:
                pop_to(at["a"][-1])
            hard, soft, good = _left_out(name, m[3])
            if name == "a":
                self.links[stack[-1]] += 1
            self.parent.append(stack[-1])
            tag.append(name)
            self.hard.append(hard)
            self.soft.append(soft)
            self.good.append(good)
            self.links.append(0)
            at.setdefault(name, []).append(len(stack))
            if name not in _INLINE:
                blocks.append(len(stack))
                chunks.append((-1, " ", False))
            stack.append(len(tag) - 1)


def main_text(page: str | None) -> str:
    """Text of the article of a page: blocks in page order, white space of any kind as one space."""
    if not page:
        return ""
    t = _Tree(page)
    tag, parent = t.tag, t.parent
    n = len(tag)
    heading = [x in ("h1", "main") for x in tag]
    for i in range(n - 1, 0, -1):
        if heading[i] and not t.hard[i]:
            heading[parent[i]] = True
    out = [False] * n                                # left out, with all below
    block = [0] * n                                  # nearest block element
    for i in range(1, n):
        out[i] = out[parent[i]] or t.hard[i] or t.soft[i] and not heading[i]
        block[i] = block[parent[i]] if tag[i] in _INLINE else i
    chars, commas, linked, texts = [0] * n, [0] * n, [0] * n, []
    last: dict[int, str] = {}
    for i, s, link in t.chunks:
        if i >= 0 and not out[i]:
            s = _html.unescape(s) if "&" in s else s
            size, b = len(s.strip()), block[i]
            chars[b] += size
            commas[b] += len(_COMMAS.findall(s))
            linked[b] += size if link else 0
            if size:
                last[b] = s.rstrip()
        texts.append(s)
    total, total_linked, links = chars[:], linked[:], t.links[:]
    for i in range(n - 1, 0, -1):
        p = parent[i]
        total[p] += total[i]
        total_linked[p] += total_linked[i]
        if not out[i]:
            links[p] += links[i]
    density = lambda i: total_linked[i] / total[i] if total[i] else 0.0
    score: dict[int, float] = {}
    for i in range(n):
        if not chars[i]:
            continue
        points = min(chars[i] / FULL_PARAGRAPH, 1) + commas[i] + min(chars[i] / POINT_CHARS, MAX_LENGTH_POINTS)
        up = block[parent[i]] if tag[i] in _PARAGRAPH else i
        for level in range(LEVELS):
            if up not in score:
                score[up] = float(_BASE.get(tag[up], 0) + (NAMED if t.good[up] else 0))
            score[up] += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            if up == 0:
                break
            up = block[parent[up]]
    if not score:
        return ""
    score = {i: s * (1 - density(i)) for i, s in score.items()}
    best = max(score, key=lambda i: (score[i], -i))
    up = best
    while up > 0:                                    # part of an article: the article
        if tag[up] in ("article", "main") and density(up) <= MENU_LINKS:
            best = up
            break
        up = parent[up]
    keep = [False] * n
    keep[best] = True
    least = max(SIBLING_LEAST, SIBLING_SHARE * score.get(best, 0.0))
    for i in range(1, n):
        if i != best and best and parent[i] == parent[best] and not out[i]:
            prose = tag[i] == "p" and (density(i) < PROSE_LINKS if chars[i] > PROSE_CHARS
                                       else not linked[i] and bool(_PROSE_END.search(last.get(i, ""))))
            keep[i] = score.get(i, 0.0) >= least or prose
    for i in range(1, n):
        menu = tag[i] in ("ul", "ol", "dl", "div", "section", "table") and links[i] >= MENU_LEAST and density(i) > MENU_LINKS
        if keep[parent[i]] and not keep[i]:
            keep[i] = not out[i] and not menu
        elif menu and i != best:
            keep[i] = False
    kept = "".join(" " if i < 0 else s for (i, _, _), s in zip(t.chunks, texts) if i < 0 or keep[i])
    return " ".join(kept.split())


def extract_main_text(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """All columns of ``pages`` but ``html_col``, plus ``out``: the page's main text.

    * NULL and empty html give an empty text, as do pages without prose.
    * Pages of any length and depth are read whole, tag by tag, in time that
      follows their length; broken markup is read as browsers do: open
      paragraphs end at the next block, unknown end tags count for nothing.
    * Ties of the best container go to the first in page order.
    * Repeated rows give equal texts; an empty table gives no rows; other
      columns of any name pass through, but for ``out``, which must not be one.
    """
    rest = [c for c in pages.columns if c != html_col]
    if out.lower() in [c.lower() for c in rest]:
        raise ValueError(f"pages has a column {out}")
    page = free_name(rest, "_page")
    keys = [f"c{i}" for i in range(len(rest))]       # names of any kind, also with dots, come back at the end
    cut = pages.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(rest, keys)], F.col(f"`{html_col}`").cast("string").alias(page))
    schema = StructType([*[StructField(k, pages.schema[c].dataType) for c, k in zip(rest, keys)], StructField("text", StringType())])

    def run(batches):
        for b in sized_batches(batches, page, BATCH_BYTES):
            texts = [main_text(x) for x in b.column(page).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keys], pa.array(texts, pa.string())], names=[*keys, "text"])

    done = cut.mapInArrow(run, schema)
    return done.select(*[F.col(k).alias(c) for c, k in zip(rest, keys)], F.col("text").alias(out))


@query("op12_html_extract")
def op12_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages).withColumn("n_chars", F.length("text").cast("long"))
