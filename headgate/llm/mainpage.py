"""Main text of web pages: the maximum-scoring run of a page's words and tags.

A page is read once into words and tags in page order. Words score positive, by the element they stand
in; tags score negative, by their name: the weights are log ratios of how often each is found inside
and outside the content of labelled pages, those that mark their own content with one `article` or
`main` element. A linear scan (Kadane's) then finds the run with the highest sum, and the page's main
text is what that run shows. Elements that are never main text by name, role or class (menus, forms,
scripts, comments of readers) are left out of the page before it is scored, so that nothing of them
is shown from inside a run either.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements that stand on lines of their own.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements without content, and elements whose start ends an open one of the same kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option", "thead": "tr", "tbody": "tr", "tfoot": "tr"}
NAMES = BLOCKS | VOID | frozenset(" a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark meter output picture progress q ruby s samp small span strike strong sub sup time tt u var".split(" "))
SCOPES = frozenset("ul ol dl table select menu".split())
#: Elements that show no text, and those whose text is not the page's main text.
HIDDEN = frozenset("audio canvas datalist head iframe math noframes noscript object script select style svg template textarea title video".split())
ASIDE = frozenset("aside button dialog fieldset footer form menu nav search".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
#: Headings, whose ids are often made of their own words.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What may stand in a page's head, which any other element ends.
IN_HEAD = frozenset("base link meta noscript script style template title".split())
#: Words of class names and ids of what surrounds main text.
SURROUND = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disclaimer disqus footer "
    "gdpr login masthead menu modal nav navbar navigation navigator newsletter notice notices notification overlay pager pagination popup promo promotion promoted "
    "recommendation recommendations recommended related respond share sharing sidebar sidebars signup skip social sponsor sponsored sponsors subscribe subscription "
    "toolbar topbar widget widgets".split()
)
#: Fixed value: a class name that begins so speaks of something else that is there, or not.
NOT_ITSELF = frozenset("has have is js no not show with without".split())
LABELS = ("article", "main")
#: Occurrences that every feature is given on either side before any page is counted.
SMOOTHING = 1.0
#: Least and greatest size of a weight: words score between, tags between the negatives.
LEAST, GREATEST = 0.05, 8.0
#: Scores of a word in an element, and of a tag, that no labelled page has.
UNKNOWN_WORD, UNKNOWN_TAG = 1.0, -0.25
#: Pages, chosen by hash, among which the labelled ones are learned from.
LABELLED = 20_000
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


def surrounds(tag: str, attributes: list[tuple[str, str | None]], inside: bool) -> bool:
    """Whether an element is none of the main text, by its name, role, class or id."""
    if tag in HIDDEN or tag in ASIDE or (tag == "header" and not inside):
        return True
    if tag in HEADINGS:
        return False
    if tag in ("html", "body", *LABELS):
        return any(n == "class" and "comment" in (v or "").lower().split() for n, v in attributes)
    for name, value in attributes:
        if name == "role" and (value or "").strip().lower() in ROLES:
            return True
        if name == "hidden" or (name == "aria-hidden" and (value or "").strip().lower() == "true"):
            return True
        if name in ("class", "id"):
            for one in (value or "").split():
                parts = [p.lower() for p in NAME_PARTS.findall(one)]
                if parts and parts[0] not in NOT_ITSELF and not SURROUND.isdisjoint(parts):
                    return True
                if parts == ["header"] and not inside:
                    return True
    return False


@dataclass
class Page(HTMLParser):
    """`items`: (feature, words, block, labelled) of a page in order; a tag has no words but None."""

    items: list[tuple[str, str | None, int, bool]] = field(default_factory=list)

    def __post_init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[str] = []
        self.out = 0  # depth of the outermost surrounding element, 0 for none
        self.block = 0
        self.labels = 0
        self.within = 0

    @classmethod
    def of(cls, html: str) -> Page:
        page = cls()
        page.feed(html)
        page.close()
        return page

    def handle_starttag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        if tag not in IN_HEAD:
            self._imply("head", SCOPES)
        if tag in BLOCKS:
            self._imply("p", BLOCKS - {"p"})
            for name in ENDS.get(tag, "").split():
                self._imply(name, SCOPES)
            self.block += 1
        if not self.out:
            self._tag(tag)
            if tag in VOID:
                self._space(tag)
                return
        elif tag in VOID:
            return
        self.open.append(tag)
        if not self.out:
            if surrounds(tag, attributes, self.within > 0):
                self.out = len(self.open)
            elif tag in LABELS:
                self.labels += self.within == 0
                self.within += 1

    def handle_endtag(self, tag: str) -> None:
        if tag == "p" and "p" not in self.open:
            self.block += 1
        if tag in self.open:
            self._close(len(self.open) - 1 - self.open[::-1].index(tag))

    def handle_data(self, data: str) -> None:
        if not self.out and data:
            inner = next((t for t in reversed(self.open) if t in BLOCKS), "")
            self.items.append((f"{inner} a" if "a" in self.open else inner, data, self.block, self.within > 0))

    def _tag(self, tag: str) -> None:
        self.items.append((f"<{tag}", None, self.block, self.within > 0))

    def _space(self, tag: str) -> None:
        if tag == "br":
            self.items.append(("", "\n", self.block, self.within > 0))

    def _imply(self, tag: str, scopes: frozenset[str]) -> None:
        """End an open `tag` that lies no deeper than the innermost of `scopes`."""
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at] == tag:
                return self._close(at)
            if self.open[at] in scopes:
                return None

    def _close(self, at: int) -> None:
        for tag in reversed(self.open[at:]):
            if not self.out and tag in LABELS:
                self.within -= 1
            if self.out == len(self.open):
                self.out = 0
            elif not self.out:
                self._tag("/" + tag)
            self.block += tag in BLOCKS
            self.open.pop()


def counted(html: str) -> Counter:
    """(feature, inside) of a labelled page's words and tags; none if the page is not labelled, or more than once."""
    page, counts = Page.of(html), Counter()
    if page.labels == 1:
        for feature, words, _, inside in page.items:
            name = feature.lstrip("</") if words is None else ""
            # The label itself is no evidence of what content looks like, nor are names that HTML has not.
            if name not in LABELS and name in NAMES:
                counts[feature, inside] += 1 if words is None else len(words.split())
    return counts


def learn(pages: DataFrame, limit: int = LABELLED) -> dict[str, float]:
    """Weights of all features from the labelled ones among about `limit` of `pages`; counts per feature reach the driver.

    Features are names of elements that HTML has, so that their number does not grow with the pages.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for html in batch.column("html"):
                total.update(counted(html.as_py() or ""))
        rows = [(f, i, n) for (f, i), n in total.items() if n]
        names, inside, n = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(inside, pa.bool_()), pa.array(n, pa.int64())], ["feature", "inside", "n"])

    whole = pages.count()
    chosen = F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(max(whole, 1))) < limit
    counts = pages.where(chosen).select("html").mapInArrow(count, "feature string, inside boolean, n long")
    found: dict[str, dict[bool, int]] = {}
    for r in counts.groupBy("feature", "inside").agg(F.sum("n").alias("n")).collect():
        found.setdefault(r["feature"], {})[r["inside"]] = r["n"]
    return weights(found)


def weights(found: dict[str, dict[bool, int]]) -> dict[str, float]:
    """Log ratios of how often a feature is inside and outside content, with the sign of its kind."""
    result = {}
    for f, n in found.items():
        ratio = math.log((n.get(True, 0) + SMOOTHING) / (n.get(False, 0) + SMOOTHING))
        result[f] = -min(max(-ratio, LEAST), GREATEST) if f.startswith("<") else min(max(ratio, LEAST), GREATEST)
    return result


def best_run(scores: list[float]) -> tuple[int, int]:
    """First and last place (exclusive) of the run with the highest sum; of equal ones that which ends first, then the shortest. Empty if no score is positive."""
    best, run, start, found = 0.0, 0.0, 0, (0, 0)
    for i, score in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += score
        if run > best:
            best, found = run, (start, i + 1)
    return found


def main_text(html: str, weight: dict[str, float]) -> str:
    """The text of the best run: blocks in page order, two line breaks between them."""
    page = Page.of(html)
    scores = [weight.get(f, UNKNOWN_TAG) if words is None else weight.get(f, UNKNOWN_WORD) * len(words.split()) for f, words, _, _ in page.items]
    start, end = best_run(scores)
    blocks: dict[int, list[str]] = {}
    for _, words, block, _ in page.items[start:end]:
        if words:
            blocks.setdefault(block, []).append(words)
    texts = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n\n".join(t for t in texts if t)


def extract(pages: DataFrame) -> DataFrame:
    """`page_id, url, text, n_chars` for every row of `pages` (`page_id`, `url`, `html`).

    A null or empty page, and one without words, has an empty text. Repeated rows are pages of their
    own; nulls in id and url stay. Without labelled pages among those learned from every word scores 1 and every tag -0.25. An
    empty table gives no rows. Other columns are left unread.
    """
    weight = learn(pages)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py() or "", weight) for html in batch.column("html")]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(read, "page_id long, url string, text string, n_chars long")
