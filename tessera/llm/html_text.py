"""Main text of web pages as the maximum-scoring contiguous region of words and tags.

1. A page is walked once into items: runs of words (with their number) and tags.  Parts that
   are no article whatever their score (menus, forms, adverts, comments and the like, told by
   element, role, class or id) are one item each and give no text.
2. Words score more than zero, tags less.  The weights come from labelled pages: those that mark
   their article themselves (an article or main element).  Spark sums how often each kind of word
   and tag lies inside and outside such a mark; the sums are a small table.  There are two sets of
   kinds: one that looks at the mark, for pages that have one, and one that is blind to it.
3. A linear scan over the items finds the region whose weights have the greatest sum.  Blocks with
   a word in the region are the text.
"""

from __future__ import annotations

import html as references
import re
from bisect import bisect_left
from collections import Counter
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import small_batches

#: Pseudo-counts behind every kind's share, and a tag's weight where it only lies outside articles.
PRIOR_ROWS, TAG_SCALE = 20, 3.25
#: The least weights of a word and of a tag.
LEAST_WORD, LEAST_TAG = {"plain": 0.25, "marked": 0.001}, 0.05

#: Names of HTML elements by what they do, and words of classes, ids and roles by what they name.
RAW = "script|style|noscript|template|textarea|title|iframe|noembed|noframes|xmp"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p blockquote pre".split())
LISTS = frozenset("ul ol li dl dt dd".split())
CELLS = frozenset("table thead tbody tfoot tr td th caption".split())
BLOCKS = HEADINGS | PARAGRAPHS | LISTS | CELLS | frozenset("address article aside body center details dialog div fieldset figcaption figure footer form header hr html legend main menu nav optgroup option section summary".split())
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
LEFT_OUT = frozenset("head nav header footer aside form select button svg math object canvas audio video dialog menu".split())
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
LEFT_OUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promoted promotion nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar widget widgets "
    "footer masthead cookie cookies consent gdpr notice notices alert copyright comment comments commentlist disqus respond reply replies share sharing social related recommended recommendations "
    "newsletter subscribe subscription signup login search popup modal overlay pagination pager toolbar banner".split()
)
ABOUT_LAYOUT = frozenset("has no with without".split())
MARKS = {"article": "article", "main": "main"}
NOT_BY_NAME = frozenset("html body article main".split())

TOKEN = re.compile(
    rf"""<!--(?:-?>|.*?(?:--!?>|\Z))
    |<[!?][^>]*>
    |<({RAW})(?=[\s/>])(?:[^<>"']|"[^"]*"|'[^']*')*+>.*?(?:</\1\s*+[^>]*>|\Z)
    |<(/?)([a-z][^\s/<>]*+)((?:[^<>"']|"[^"]*"|'[^']*')*+)>
    |<(/?)([a-z][^\s/<>]*+)([^<>]*+)>""",
    re.IGNORECASE | re.DOTALL | re.VERBOSE,
)
ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
NAME_PART = re.compile(r"[a-z]+|[0-9]+")
FORM_END, TITLE = re.compile(r"</form", re.IGNORECASE), re.compile(r"<h1[\s>]", re.IGNORECASE)


def _named(attributes: str) -> tuple[set[str], bool, bool]:
    """(roles and properties, does a class or id name something left out, does one name a header)."""
    marks, out, head = set(), False, False
    for key, value in ATTRIBUTE.findall(attributes):
        words = value.strip("\"'").split()
        if key.lower() in ("role", "itemprop"):
            marks.update(w.lower() for w in words)
            continue
        for word in words:
            parts = set(NAME_PART.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", word).lower()))
            if not parts & ABOUT_LAYOUT:
                out, head = out or bool(parts & LEFT_OUT_NAMES), head or "header" in parts
    return marks, out, head


class Page:
    """Items of a page: (kind, words, block, in article, in main); kind "w:..." for words, "t:..." for tags, "t:#part" for a part left out."""

    def __init__(self, source: str):
        self.items: list[tuple[str, int, int, bool, bool]] = []
        self.blocks: list[list[str]] = [[]]
        self.articles, self.mains, self.link = 0, 0, 0
        self.around: list[str] = []  # open elements that say what kind of words they hold
        self.out, self.depth, self.inner, self.header = "", 0, False, False  # the element left out, how deep in it, whether it lies in an article, whether it is a header
        self.forms: tuple[list[int], list[int]] | None = None  # where forms end, where titles are
        self.heading = False  # in a heading of an article's header
        at = 0
        for m in TOKEN.finditer(source):
            if m.start() > at:
                self._words(source[at : m.start()])
            at = m.end()
            name = m[3] or m[6]
            if name:
                form = name.lower() == "form" and not (m[2] or m[5]) and self._wraps(source, at)
                self._tag("div" if form else name.lower(), bool(m[2] or m[5]), (m[4] if m[3] else m[7]) or "")
        self._words(source[at:])

    def _wraps(self, source: str, at: int) -> bool:
        """Does the form that starts here hold the page's title?  Then it is there for technical reasons."""
        if self.forms is None:
            self.forms = [m.start() for m in FORM_END.finditer(source)], [m.start() for m in TITLE.finditer(source)]
        ends, titles = self.forms
        k, n = bisect_left(ends, at), bisect_left(titles, at)
        return n < len(titles) and (k == len(ends) or titles[n] < ends[k])

    def _context(self) -> str:
        return f"{self.around[-1] if self.around else 'other'}{'-link' if self.link else ''}"

    def _add(self, kind: str, words: int) -> None:
        self.items.append((kind, words, len(self.blocks) - 1, self.articles > 0, self.mains > 0))

    def _words(self, raw: str) -> None:
        if self.out and not self.heading:
            return
        text = references.unescape(raw) if "&" in raw else raw
        self.blocks[-1].append(text)
        if n := len(text.split()):
            self._add(f"w:{self._context()}", n)

    def _new_block(self) -> None:
        if self.blocks[-1]:
            self.blocks.append([])

    def _tag(self, name: str, closing: bool, attributes: str) -> None:
        if name in BLOCKS and not (self.out and not self.heading):
            self._new_block()
        marks, named_out, named_head = _named(attributes) if attributes and not closing else ((), False, False)
        mark = MARKS.get(name) or ("main" if "main" in marks or "articlebody" in marks else None)
        commented = named_out and name != "main" and (name not in NOT_BY_NAME or name == "article")
        if self.out:
            if self._ended(name, closing, mark is not None and not commented):
                return
        if closing:
            self._close(name)
            return
        left_out = name in LEFT_OUT or bool(LEFT_OUT_ROLES & set(marks)) or (named_head and name not in NOT_BY_NAME) or commented
        if left_out and name not in VOID and (mark is None or commented):
            self._add("t:#part", 0)
            self.out, self.depth, self.inner = name, 1, self.articles + self.mains > 0
            self.header = name == "header" or (named_head and not named_out)
            return
        if name == "article":
            self.articles += 1
        elif name == "main":
            self.mains += 1
        elif name == "a":
            self.link = 1
        kind = self._kind(name)
        if kind:
            if self.around and name in ("p", "li") and self.around[-1] == kind:
                self.around.pop()
            self.around.append(kind)
        if name not in MARKS:
            self._add(f"t:{name if name in BLOCKS or name in INLINE else '?'}@{self._context()}", 0)
        if name == "br":
            self.blocks[-1].append(" ")

    @staticmethod
    def _kind(name: str) -> str | None:
        return "head" if name in HEADINGS else "par" if name in PARAGRAPHS else "list" if name in LISTS else "cell" if name in CELLS else None

    def _close(self, name: str) -> None:
        if name not in MARKS:
            self._add(f"t:{name if name in BLOCKS or name in INLINE else '?'}@{self._context()}", 0)
        if name == "article":
            self.articles = max(0, self.articles - 1)
        elif name == "main":
            self.mains = max(0, self.mains - 1)
        elif name == "a":
            self.link = 0
        if (kind := self._kind(name)) and kind in self.around:
            while self.around.pop() != kind:
                pass

    def _ended(self, name: str, closing: bool, mark: bool) -> bool:
        """Follow tags in a part left out: it ends with its element, with the article or page around it, or where an article starts.

        Is nothing left to do for this tag?
        """
        if self.inner and self.header and name in HEADINGS:
            if not closing:
                self._new_block()
            self.heading = not closing
        if closing and name == self.out:
            self.depth -= 1
        elif not closing and name == self.out and name not in ("p", "head"):
            self.depth += 1
        ends = closing and (name == "body" or (name in MARKS and self.inner and name != self.out))
        starts = not closing and ((mark and name != self.out) or (self.out == "head" and name == "body") or (self.out == "p" and name in BLOCKS))
        if self.depth <= 0 or ends or starts:
            self.out, self.depth, self.heading = "", 0, False
            self._new_block()
            return closing and not ends
        return True

    def mode(self) -> tuple[str, int]:
        """("marked", index of the item's flag to go by) for a page that marks an article, else ("plain", -1)."""
        for flag in (3, 4):
            if any(x[1] and x[flag] for x in self.items):
                return "marked", flag
        return "plain", -1


def counted(page: Page) -> Counter:
    """(kind, inside) -> number, of the words and tags of a page that marks an article; none of any other page."""
    found: Counter = Counter()
    mode, flag = page.mode()
    if mode == "marked":
        for x in page.items:
            found[f"plain {x[0]}", x[flag]] += x[1] or 1
            found[f"marked {'in' if x[flag] else 'out'} {x[0][0]}", x[flag]] += x[1] or 1
    return found


def prior(kind: str) -> float:
    """The share of a kind that lies in articles before any page was seen."""
    if kind.startswith("marked"):
        return 0.99 if " in " in kind else 0.01
    name = kind.partition(":")[2].partition("@")[0]
    if " w:" in kind:
        return 0.3 if name.endswith("-link") else 0.7
    return 0.5 if name in BLOCKS - HEADINGS - PARAGRAPHS - LISTS - CELLS or name == "?" else 0.9


def weight_of(kind: str, inside: int, outside: int) -> float:
    """A word's weight, above zero, or a tag's, below."""
    share = (inside + PRIOR_ROWS * prior(kind)) / (inside + outside + PRIOR_ROWS)
    mode = kind.partition(" ")[0]
    words = " w" in kind
    return LEAST_WORD[mode] + (1 - LEAST_WORD[mode]) * share if words else -(LEAST_TAG + TAG_SCALE * (1 - share))


def best_region(weights: list[float]) -> tuple[int, int]:
    """(first, end) of the contiguous region with the greatest sum, the first and shortest of equal ones; (0, 0) if none is above zero."""
    best, found, total, first = 0.0, (0, 0), 0.0, 0
    for k, w in enumerate(weights):
        if total <= 0:
            total, first = 0.0, k
        total += w
        if total > best:
            best, found = total, (first, k + 1)
    return found


def main_text(source: str | None, weights: dict[str, float]) -> str:
    """The main text of a page, under the weights of kinds; kinds that they lack weigh as before any page was seen."""
    page = Page(source or "")
    mode, flag = page.mode()

    def weight(x) -> float:
        kind = f"marked {'in' if x[flag] else 'out'} {x[0][0]}" if mode == "marked" else f"plain {x[0]}"
        w = weights.get(kind)
        if w is None:
            w = weights[kind] = weight_of(kind, 0, 0)
        return w * (x[1] or 1)

    first, end = best_region([weight(x) for x in page.items])
    chosen = [b for b, _ in groupby(x[2] for x in page.items[first:end] if x[1])]
    texts = (" ".join("".join(page.blocks[b]).split()) for b in chosen)
    return "\n\n".join(t for t in texts if t)


def learned_weights(pages: DataFrame) -> dict[str, float]:
    """Weights of words and tags from the pages (html) that mark their article.

    Every such page counts, its text whole; the sums have a row per kind, of which there are a few
    hundred at most.
    """
    small_batches(pages.sparkSession)

    def count(batches):
        sums: Counter = Counter()
        for batch in batches:
            for source in batch.column(0).to_pylist():
                sums.update(counted(Page(source or "")))
        kinds = sorted(sums)
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in kinds], pa.string()), pa.array([i for _, i in kinds], pa.bool_()), pa.array([sums[k] for k in kinds], pa.int64())], ["kind", "inside", "n"])

    found = pages.select("html").mapInArrow(count, "kind string, inside boolean, n long").groupBy("kind")
    sums = found.agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("inside"), F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("outside"))
    return {r["kind"]: weight_of(r["kind"], r["inside"], r["outside"]) for r in sums.collect()}


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages (page_id, url, html): the article's text, blocks joined by an empty line.

    Without weights they are learned from the pages themselves.  Null and empty html, and pages
    without words, give an empty text; so does a page of nothing but parts left out.  White space
    (as Unicode has it, no-break spaces too) is one space inside a block; a line break element is
    white space.  Unclosed elements, comments and quotes are read to where a browser would end
    them at the latest.  The header of an article gives its headings only, and a form that holds the page's title is
    read as if it weren't there.  Repeated rows give
    equal rows; null ids and urls stay.
    """
    weights = learned_weights(pages) if weights is None else weights
    small_batches(pages.sparkSession)

    def read(batches):
        known = dict(weights)
        for batch in batches:
            texts = [main_text(source, known) for source in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(read, "page_id long, url string, text string, n_chars long")


#: The article of pages that mark it by one plain element with paragraphs, headings, bold text and breaks, as those of the given tables do.
ORACLE = r"""
WITH inner_ AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS a FROM pages),
parts AS (SELECT page_id, url, string_split(regexp_replace(regexp_replace(a, '</?(p|h1)>', chr(1), 'g'), '</?b>', '', 'g'), chr(1)) AS p FROM inner_),
blocks AS (
  SELECT page_id, url, list_transform(p, lambda x: trim(regexp_replace(replace(x, '<br>', ' '), '\s+', ' ', 'g'))) AS b FROM parts),
decoded AS (
  SELECT page_id, url, list_transform(list_filter(b, lambda x: x <> ''),
    lambda x: regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(replace(x, '&middot;', '·'), '&copy;', '©'), '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g')) AS b
  FROM blocks)
SELECT page_id, url, array_to_string(b, chr(10) || chr(10)) AS text, length(array_to_string(b, chr(10) || chr(10))) AS n_chars FROM decoded
"""
