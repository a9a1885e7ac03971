"""Main text of HTML pages: the maximum-scoring subsequence of words and tags.

A page is a sequence of tags and runs of words.  A word scores 1; a tag costs
as many words as it is times likelier outside of the main text than inside, as
labelled pages show for its name and for the words of its class and id.  One
linear scan finds the contiguous region of the highest sum, which is then
widened to the borders of the blocks that it begins and ends in; the words of
that region are the main text.

What lies inside an article and is no article text is passed over by the scan
and left out of the region: elements that say so by their name or role (menus,
footers, sidebars, forms and the like, headers outside of an article, hidden
parts), and those with a word of class or id that is OUTSIDE times likelier
outside.  An element is never passed over if it holds the page's main text by
its marks (the main element or, without one, the article with the most words),
or most of the words outside of links of that element or, without one, of the
page; only readers' comments, menus, footers and controls stay out even then.

Costs: (outside + prior) / (inside + prior) over the labelled pages, between
LEAST and one more than the most words that a labelled page has outside of its
main text.  Labelled pages are those that mark their main text themselves, by an
article or main element; the label is that element's inside, and the element's
own tags are outside.  A name inside of such an element is text, so it costs what
names inside cost; elsewhere it costs by where the name lies on labelled pages.
Names in elements that are left out by their marks aren't counted.  The fit takes a sample of at most about ``fit_pages``
pages, drawn by a hash of the key.  Priors stand for a few observations: names
as they lie in texts, and words that name menus, adverts, comments and so on.

Edge cases: null and empty html give the empty text; so do pages without words
outside left-out elements; without labelled pages the priors decide; tags that
never close end with their parent, those cut off at the page's end are dropped;
a slash at a tag's end closes nothing; references are decoded in each run of
text by itself; equal pages give equal texts; ties go to the earlier and shorter
region; pages are read whole; ``with_main_text`` replaces a column that has the
output's name.
"""

from __future__ import annotations

import html as html_module
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST, OUTSIDE = 0.05, 10.0
#: The most words outside of main texts where no labelled page tells.
MOST_WORDS = 60.0
#: A comment, a raw-text element, a declaration, a tag, or a tag that the page's end cuts off.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|svg|iframe)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>|</?[a-zA-Z!?][^>]*\Z",
    re.S | re.I,
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
OUT = frozenset("nav header footer aside form menu dialog button select option input label fieldset head title object canvas audio video".split())
#: Names that never hold a main text by themselves, however many words they have.
NEVER = OUT - frozenset("header aside form dialog label fieldset object canvas".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
MAIN = frozenset(("article", "main"))
#: Ends the key of a name inside of an article or main element, where it is text; elsewhere, on a page that marks no main text, the name alone tells.
INSIDE = "@main"
#: Names that hold anything; where such an element has a class or id, that is what it is counted by.
BOXES = frozenset("div section td th tr table tbody thead tfoot dl dt dd center figure figcaption details summary".split())
#: Words of classes and ids that lie outside, by prior; the second only outside of an article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs sidebar aside rail footer foot"
    " comment comments commentlist disqus respond reply replies cookie cookies consent gdpr notice notices notification alert warning modal popup overlay newsletter subscribe"
    " subscription signup login share sharing social related recommended recommendations widget widgets pagination pager copyright".split()
)
HEADS = frozenset("banner header masthead topbar toolbar side search skip form discussion".split())
#: Words that mark readers' text.
READERS = frozenset("comment comments commentlist disqus respond reply replies".split())
#: Names of layouts by what they have or lack are no marks.
LAYOUT = re.compile(r"(?:has|have|with|without|no)[-_]", re.I)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
PARTS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")


class Element:
    """A tag's name, the words of its class and id as keys, and what its attributes say."""

    __slots__ = ("name", "keys", "out", "readers")

    def __init__(self, name: str, attributes: str, in_main: bool):
        self.name, self.keys, self.readers = name, (f"{name}{INSIDE}" if in_main and name not in MAIN else name,), False
        self.out = name in OUT and not (name in ("header", "label") and in_main)
        if not attributes or name in ("html", "body"):
            return
        if "hidden" in attributes.lower() and re.search(r"(?:^|\s)hidden(?:\s|$|=)", re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes), re.I):
            self.out = True
        found = []
        for key, *values in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), next((v for v in values if v), "")
            if key == "role" and value.lower() in ROLES or key == "aria-hidden" and value.lower() == "true" or key == "style" and HIDDEN.search(value):
                self.out = True
            elif key in ("class", "id"):
                found += [v for v in value.split() if not LAYOUT.match(v)]
        words = {p.lower() for v in found for p in PARTS.findall(v)}
        self.readers = bool(words & READERS)
        if name not in MAIN:
            # the words one by one in an article and elsewhere: what a header or a discussion is depends on it
            self.keys += tuple(sorted(f"{'+' if in_main else '.'}{w}" for w in words))


def prior(key: str) -> tuple[float, float]:
    """Observations (outside, inside) that stand for no page."""
    if key[0] in ".+":
        if key[1:] in MARKS or key[0] == "." and key[1:] in HEADS:
            return OUTSIDE, 0.5
        return (0.5, 2.0) if key[0] == "." else (0.5, 5.0)
    return (0.5, 2.0) if key in BOXES else (0.5, 0.5) if key in MAIN else (0.5, 5.0)


class Weights:
    """Costs of keys in words."""

    def __init__(self, counts: dict[str, tuple[int, int]] | None = None, most: float = MOST_WORDS):
        self.most = most
        self.costs = {k: self._cost(k, o, i) for k, (o, i) in (counts or {}).items()}

    def _cost(self, key: str, outside: int, inside: int) -> float:
        o, i = prior(key)
        return min(self.most + 1, max(LEAST, (outside + o) / (inside + i)))

    def of(self, key: str) -> float:
        got = self.costs.get(key)
        return self._cost(key, 0, 0) if got is None else got

    def cost(self, element: Element) -> float:
        """What the element's tags cost each: the most of its keys."""
        return max(map(self.of, element.keys))

    def outside(self, element: Element) -> bool:
        """Whether a word of class or id is mostly seen outside of main texts."""
        return any(self.of(k) >= min(OUTSIDE, self.most + 1) for k in element.keys[1:])


class Page:
    """A page as tokens: runs of text, tags, and the element in which each lies."""

    def __init__(self, source: str):
        #: (text or None, parent element, the tag's element): None for a tag; the tag's element of a void or stray tag is only its name.
        self.tokens: list[tuple[str | None, int, Element | None]] = []
        #: Of each element: what it is, its parent, first token, token after the last.
        self.kinds: list[Element] = [Element("", "", False)]
        self.up, self.first, self.after = [-1], [0], [0]
        self._open, self._in_main, stack, at = Counter(), 0, [0], 0
        self._plains: dict[tuple[str, bool], Element] = {}
        for m in TOKEN.finditer(source):
            if m.start() > at:
                self.tokens.append((source[at : m.start()], stack[-1], None))
            at = m.end()
            name = (m[3] or m[6] or "").lower()
            if not name:
                continue
            if m[2] or m[5]:
                closed = self._close(name, stack)
                if closed:  # an end tag lies in its element, so that it costs nothing where that is passed over
                    self.tokens.append((None, closed, self.kinds[closed]))
                else:
                    self.tokens.append((None, stack[-1], self._plain(name)))
                continue
            attributes = m[4] or m[7] or ""
            if name in CLOSES_P and any(self.kinds[e].name == "p" for e in stack[-4:]):
                self._close("p", stack)
            same = SAME.get(name)
            if same and any(self._open[x] for x in same):
                for e in reversed(stack):
                    if self.kinds[e].name in HOLDS[name]:
                        break
                    if self.kinds[e].name in same:
                        self._close(self.kinds[e].name, stack)
                        break
            kind = Element(name, attributes, self._in_main > 0) if attributes.strip(" /\n\t") else self._plain(name)
            if name in VOID:
                self.tokens.append((None, stack[-1], kind))
                continue
            self.kinds.append(kind)
            self.up.append(stack[-1])
            self.first.append(len(self.tokens))
            self.after.append(-1)
            stack.append(len(self.kinds) - 1)
            self._open[name] += 1
            self._in_main += name in MAIN
            self.tokens.append((None, stack[-1], kind))
        if at < len(source):
            self.tokens.append((source[at:], stack[-1], None))
        for e in stack:
            self.after[e] = len(self.tokens)

    def _plain(self, name: str) -> Element:
        """An element without attributes, one for each name and side of the main text's border."""
        key = name, self._in_main > 0
        if key not in self._plains:
            self._plains[key] = Element(name, "", key[1])
        return self._plains[key]

    def _close(self, name: str, stack: list[int]) -> int:
        """Ends the innermost open element of a name with all in it and gives its number; a stray end tag does nothing and gives 0."""
        if not self._open[name]:
            return 0
        while True:
            e = stack.pop()
            kind = self.kinds[e]
            self.after[e] = len(self.tokens) + 1
            self._open[kind.name] -= 1
            self._in_main -= kind.name in MAIN
            if kind.name == name:
                return e

    def words(self) -> list[int]:
        """Of each element: words outside of links in it and below."""
        words, in_link = [0] * len(self.kinds), [False] * len(self.kinds)
        for e, kind in enumerate(self.kinds):
            in_link[e] = kind.name == "a" or e > 0 and in_link[self.up[e]]
        for text, e, _ in self.tokens:
            if text is not None and not in_link[e]:
                words[e] += len(text.split())
        for e in range(len(self.kinds) - 1, 0, -1):
            words[self.up[e]] += words[e]
        return words

    def main(self, words: list[int]) -> int:
        """The element that marks the main text, 0 if none does: the largest main element or, without one, article."""
        for name in ("main", "article"):
            found = [e for e, k in enumerate(self.kinds) if k.name == name and words[e] and not k.readers]
            if found:
                return max(found, key=lambda e: words[e])
        return 0

    def passed_over(self, weights: Weights) -> list[bool]:
        """Of each element, whether it is no article text; what holds the main text stays."""
        own = [kind.out or len(kind.keys) > 1 and weights.outside(kind) for kind in self.kinds]
        out = [False] * len(self.kinds)
        if not any(own):
            return out
        words = self.words()
        scope = e = self.main(words)
        holds = set()
        while e > 0:
            holds.add(e)
            e = self.up[e]
        for e in range(1, len(self.kinds)):
            if own[e] and e not in holds and words[e] * 2 > words[scope]:
                within = scope == 0 or self.first[scope] <= self.first[e] < self.after[scope]
                own[e] = not within or self.kinds[e].readers or self.kinds[e].name in NEVER
            out[e] = out[self.up[e]] or own[e] and e not in holds
        return out

    def scores(self, weights: Weights, out: list[bool]) -> list[float]:
        """1 for each word, less for each tag; nothing for what is passed over."""
        costs: dict[int, float] = {}
        found = []
        for text, e, kind in self.tokens:
            if text is not None:
                found.append(0.0 if out[e] else float(len(text.split())))
            elif out[e]:
                found.append(0.0)
            else:
                key = id(kind)
                if key not in costs:
                    costs[key] = -weights.cost(kind)
                found.append(costs[key])
        return found

    def text(self, weights: Weights) -> str:
        """The main text: the best region's words, blocks joined by one space."""
        out = self.passed_over(weights)
        lo, hi = best_region(self.scores(weights, out))
        if lo == hi:
            return ""
        inline = [text is not None or kind.name in INLINE for text, _, kind in self.tokens]
        while lo > 0 and inline[lo - 1]:
            lo -= 1
        while hi < len(self.tokens) and inline[hi]:
            hi += 1
        parts = []
        for text, e, kind in self.tokens[lo:hi]:
            if text is not None:
                if not out[e]:
                    parts.append(html_module.unescape(text) if "&" in text else text)
            elif kind.name not in INLINE:
                parts.append("\n")
        return " ".join("".join(parts).split())


def best_region(scores: list[float]) -> tuple[int, int]:
    """(first, after) of the maximum-scoring subsequence, the earliest and shortest of those; empty if no score is positive."""
    best, run, start, span = 0.0, 0.0, 0, (0, 0)
    for i, score in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += score
        if run > best:
            best, span = run, (start, i + 1)
    return span


def page_counts(source: str) -> tuple[dict[str, tuple[int, int]], int]:
    """Of a page that marks its main text: (outside, inside) of each key, and the words outside; of another, nothing."""
    page, counts = Page(source), {}
    words = page.words()
    e = page.main(words)
    if not e:
        return {}, 0
    lo, hi = page.first[e], page.after[e]
    left, none = [kind.out for kind in page.kinds], Weights()

    def count(keys: tuple[str, ...], inside: bool) -> None:
        for key in keys:
            for k in {key, key.removesuffix(INSIDE)}:
                o, i = counts.get(k, (0, 0))
                counts[k] = (o + (not inside), i + inside)

    for k, kind in enumerate(page.kinds):
        if not k:
            continue
        left[k] = left[k] or left[page.up[k]]
        if left[k]:  # the scan passes it over
            continue
        holds = page.first[k] < lo and page.after[k] >= hi
        marked = not holds and none.outside(kind)  # its own words are counted, names in it tell nothing
        count(kind.keys[marked or len(kind.keys) > 1 and kind.name in BOXES :], lo < page.first[k] < hi or holds)
        left[k] = marked
    for n, (text, up, kind) in enumerate(page.tokens):  # void tags aren't elements
        if text is None and kind.name in VOID and not left[up]:
            count(kind.keys[:1], lo <= n < hi)
    outside = sum(len(t.split()) for n, (t, k, _) in enumerate(page.tokens) if t is not None and not lo <= n < hi and not left[k])
    return counts, outside


def fit(pages: DataFrame, html: str = "html", key: str = "page_id", fit_pages: int = 4000) -> Weights:
    """Costs of keys from the labelled pages among ``pages``; the driver gets the counts of the sample's keys."""
    marked = pages.select(F.col(html).alias("html"), F.col(key).alias("key")).filter(F.lower("html").rlike("<(article|main)[\\s>]"))
    n = marked.count()
    drawn = F.xxhash64(F.coalesce(F.col("key").cast("string"), F.lit(""))).bitwiseAND((1 << 40) - 1) / float(1 << 40)

    def count(batches):
        outside, inside, most = Counter(), Counter(), 0
        for batch in batches:
            for source in batch.column(0):
                counts, words = page_counts(source.as_py())
                most = max(most, words)
                for k, (o, i) in counts.items():
                    outside[k] += o
                    inside[k] += i
        keys = list(outside)
        yield pa.RecordBatch.from_arrays([pa.array([*keys, ""]), pa.array([*map(outside.get, keys), most]), pa.array([*map(inside.get, keys), 0])], names=["key", "o", "i"])

    sample = marked.filter(drawn < min(1.0, fit_pages / max(1, n))).select("html")
    rows = sample.mapInArrow(count, "key string, o long, i long").groupBy("key").agg(F.sum("o").alias("o"), F.sum("i").alias("i"), F.max("o").alias("most")).collect()
    most = max((r["most"] for r in rows if not r["key"]), default=0)
    return Weights({r["key"]: (r["o"], r["i"]) for r in rows if r["key"]}, float(most) if most else MOST_WORDS)


def with_main_text(pages: DataFrame, weights: Weights, html: str = "html", out: str = "main_text") -> DataFrame:
    """``pages`` with a column ``out``: the main text of each whole page."""
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    @F.arrow_udf("string")
    def extract(sources: pa.Array) -> pa.Array:
        return pa.array([Page(x.as_py()).text(shared.value) if x.is_valid else "" for x in sources], pa.string())

    return pages.withColumn(out, extract(F.col(html)))


def op7_html_main(pages: DataFrame) -> DataFrame:
    """Main text of every page."""
    found = with_main_text(pages.select("page_id", "url", "html"), fit(pages))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))
