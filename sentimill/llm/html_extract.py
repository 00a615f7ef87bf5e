"""Main text of web pages by consensus container paths of a host.

Method: each page is parsed leniently into elements.  From the root on, the page's main container is looked for among all text
below each container that is not in links: one is left for its largest inner container only if that has nearly all of this text
and no heading or paragraph of its own would be lost.  The main container votes for its generalised path, the tags and classes from the root with
digits left out.  Votes of a host's different pages are added up in Spark.  A page takes, of all paths of its host that cover its main container,
the one with the most votes.  If no other page has voted for that, and more than half of the votes are for a path the page
has, it takes this one; else it keeps its own main container.  Pages without a host decide alone.

Extraction takes the container's text in page order, without elements that are navigation, headers of the page, footers,
asides, forms, adverts, notices, comments, scripts or styles by their tag, role, class or id; a class or id that only
looks like one of these is passed over if the element has most of the page's paragraph text.  Character references are decoded,
white space becomes one space, blocks are joined by one space.

Null and empty pages have an empty text; broken markup (open tags, stray ends, unclosed comments or
scripts) is read as far as it goes; repeated rows give repeated results; other columns are not read.  Every scan over a page is linear.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentimill.llm.common import map_batches
from sentimill.plans.staging import stage

#: Share of a container's text its largest inner container must have to be taken in its place.
NEARLY_ALL = 0.8
#: Share of a page's main container that a path must hold to cover it.
COVERS = 0.9

_VOID = frozenset(
    (
        "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
        "track", "wbr",
    )
)
_RAW = frozenset(
    (
        "script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "xmp", "noembed",
        "noframes", "title", "select", "object",
    )
)
_BLOCK = frozenset(
    (
        "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div",
        "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5",
        "h6", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary",
        "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "br",
    )
)
_PARAGRAPH = frozenset(
    (
        "p", "pre", "blockquote", "li", "dd", "dt", "td", "th", "h1", "h2", "h3", "h4", "h5", "h6",
        "figcaption",
    )
)
_CONTAINER = frozenset(
    (
        "article", "body", "center", "div", "main", "section", "td", "html", "blockquote",
    )
)
_CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",),
}
_SCOPE = frozenset(
    (
        "ul", "ol", "dl", "table", "article", "section", "div", "main", "body", "html", "nav", "aside",
        "header", "footer", "form", "td", "th", "blockquote",
    )
)
_APART_TAGS = frozenset(
    (
        "nav", "footer", "aside", "form", "button", "dialog", "menu", "head",
    )
)
_APART_ROLES = frozenset(
    (
        "navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu",
        "menubar", "form",
    )
)
_APART_NAMES = frozenset(
    (
        "ad", "ads", "adv", "advert", "adverts", "advertisement", "adslot", "banner", "breadcrumb",
        "breadcrumbs", "comment", "comments", "commentlist", "consent", "cookie", "cookies", "disqus",
        "footer", "gdpr", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter",
        "notice", "notification", "pagination", "popup", "promo", "promoted", "related", "replies",
        "respond", "share", "sharing", "sidebar", "sidenav", "signup", "skip", "social", "sponsor",
        "sponsored", "subscribe", "subscription", "toolbar", "topbar", "widget",
    )
)

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^<>\"']*)>")
_QUOTED = re.compile(r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME = re.compile(r"[^\W\d_]+")
_DENIALS = frozenset(("has", "no", "not", "with", "without"))
_DIGITS = re.compile(r"\d+")


def _names_apart(value: str) -> bool:
    """Whether a part of a class or id is a name of boilerplate that no part before it denies."""
    for token in value.split():
        for part in _NAME.findall(token):
            if part in _DENIALS:
                break
            if part in _APART_NAMES:
                return True
    return False


def _self_closed(attributes: str) -> bool:
    """Whether a tag ends with a slash that is not part of an unquoted value."""
    last = attributes.split()[-1:]
    if not last or not last[0].endswith("/"):
        return False
    return "=" not in last[0] or last[0][-2:-1] in ("'", '"')


class Page:
    """Elements (tag, generalised path, parent, whether apart, whether in a link) and the text between their tags."""

    def __init__(self, source: str) -> None:
        self.tags, self.paths, self.parents, self.apart, self.linked = ["html"], [path_step(0, "html")], [-1], [False], [False]
        self.pieces: list[tuple[int, str]] = []
        self._open = [0]
        self._doubtful: list[int] = []
        self._read(source)
        self._decide()

    def _read(self, source: str) -> None:
        at, quoted = 0, True
        unclosed: set[str] = set()
        while True:
            start = source.find("<", at)
            if start < 0:
                self._text(source[at:])
                return
            self._text(source[at:start])
            if source.startswith("<!--", start):
                end = source.find("-->", start + 4)
                if end < 0:
                    return
                at = end + 3
                continue
            if source[start + 1 : start + 2] in ("!", "?"):
                end = source.find(">", start)
                if end < 0:
                    return
                at = end + 1
                continue
            tag = _TAG.match(source, start)
            if tag is None and quoted:
                tag = _QUOTED.match(source, start)
                # A quote that is never closed would be looked for again at every tag.
                quoted = tag is not None or source[start + 1 : start + 2] not in "/abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
            if tag is None:
                self._text("<")
                at = start + 1
                continue
            at = tag.end()
            name = tag.group(2).lower()
            if tag.group(1):
                self._end(name)
            elif name in _RAW:
                code = name in ("script", "style")
                if not code and _self_closed(tag.group(3)):
                    continue
                # A name once not found is not looked for again.
                closing = None if name in unclosed else re.compile(f"</{re.escape(name)}", re.I).search(source, at)
                end = source.find(">", closing.end()) if closing else -1
                if end >= 0:
                    at = end + 1
                    continue
                unclosed.add(name)
                if code:
                    # As in a browser, all that follows is code.
                    return
            else:
                self._start(name, tag.group(3))

    def _text(self, text: str) -> None:
        if text:
            self.pieces.append((self._open[-1], text))

    def _break(self) -> None:
        self.pieces.append((self._open[-1], " "))

    def _start(self, name: str, attributes: str) -> None:
        if name in _BLOCK:
            self._break()
        if name in _VOID:
            return
        if name in _BLOCK and name != "br":
            self._close_implied(("p",))
        if name in _CLOSES:
            self._close_implied(_CLOSES[name])
        parent = self._open[-1]
        label, apart, doubtful = name, self.apart[parent] or name in _APART_TAGS, False
        if "=" in attributes:
            for found in _ATTRIBUTE.finditer(attributes):
                key, value = found.group(1).lower(), next(v for v in found.groups()[1:] if v is not None).lower()
                if key == "class":
                    label = ".".join([name, *sorted({_DIGITS.sub("", v) for v in value.split()} - {""})])
                if key == "role":
                    apart = apart or value.strip() in _APART_ROLES
                elif name not in ("body", "article", "main"):
                    doubtful = doubtful or _names_apart(value)
        if name == "header" and not any(self.tags[i] in ("article", "main") for i in self._open):
            apart = True
        if name in ("html", "body") and name in (self.tags[i] for i in self._open):
            return
        self.tags.append(name)
        self.paths.append(path_step(self.paths[parent], label))
        self.parents.append(parent)
        self.apart.append(apart)
        self.linked.append(self.linked[parent] or name == "a")
        if doubtful and not apart:
            self._doubtful.append(len(self.tags) - 1)
        self._open.append(len(self.tags) - 1)

    def _close_implied(self, names: tuple[str, ...]) -> None:
        for depth in range(len(self._open) - 1, 0, -1):
            tag = self.tags[self._open[depth]]
            if tag in names:
                del self._open[depth:]
                return
            if tag in _SCOPE:
                return

    def _end(self, name: str) -> None:
        if name in _BLOCK:
            self._break()
        for depth in range(len(self._open) - 1, 0, -1):
            tag = self.tags[self._open[depth]]
            if tag == name:
                del self._open[depth:]
                return
            # An inline end tag does not reach over a block.
            if name not in _BLOCK and tag in _BLOCK:
                return

    def _sizes(self, counted: list[bool] | None = None) -> list[int]:
        """Text below each element that is not apart (and directly in a counted element).

        Text in links counts only if there is no other.
        """
        sizes = [0] * len(self.tags)
        for self._links in (False, True):
            for at, text in self.pieces:
                if self._counts(at) and (counted is None or counted[at]):
                    sizes[at] += len(text.strip())
            if any(sizes):
                break
        for i in range(len(sizes) - 1, 0, -1):
            sizes[self.parents[i]] += sizes[i]
        return sizes

    def _counts(self, at: int) -> bool:
        return not self.apart[at] and (self._links or not self.linked[at])

    def _decide(self) -> None:
        """Set apart what is named like boilerplate and does not have most of the page's paragraph text."""
        if not self._doubtful:
            return
        paragraph = [False] * len(self.tags)
        for i in range(1, len(self.tags)):
            paragraph[i] = paragraph[self.parents[i]] or self.tags[i] in _PARAGRAPH
        sizes = self._sizes(paragraph)
        for i in self._doubtful:
            self.apart[i] = 2 * sizes[i] <= sizes[0]
        for i in range(1, len(self.tags)):
            self.apart[i] = self.apart[i] or self.apart[self.parents[i]]

    def main(self) -> tuple[int | None, list[int]]:
        """The page's main container, none without text, and the sizes of all elements."""
        sizes = self._sizes()
        if not sizes[0]:
            return None, sizes
        n = len(self.tags)
        holder, largest = [0] * n, [-1] * n
        paragraphs, plain, headings = [0] * n, [0] * n, [0] * n
        in_paragraph = [False] * n
        for i in range(1, n):
            parent, tag = self.parents[i], self.tags[i]
            above = holder[parent]
            holder[i] = i if tag in _CONTAINER and tag != "blockquote" else above
            in_paragraph[i] = holder[i] != i and (in_paragraph[parent] or tag in _PARAGRAPH)
            headings[i] += tag == "h1" and sizes[i] > 0
            if holder[i] == i and sizes[i] and (largest[above] < 0 or sizes[i] > sizes[largest[above]]):
                largest[above] = i
        for i in range(n - 1, 0, -1):
            headings[self.parents[i]] += headings[i]
        for at, text in self.pieces:
            if self._counts(at):
                (paragraphs if in_paragraph[at] else plain)[holder[at]] += len(text.strip())
        at = 0
        while largest[at] >= 0:
            inner, outermost = largest[at], self.tags[at] in ("html", "body")
            if sizes[inner] < NEARLY_ALL * sizes[at]:
                break
            if not outermost and (paragraphs[at] or headings[at] > headings[inner]):
                break
            if 10 * (paragraphs[at] + plain[at]) > sizes[at]:
                break
            at = inner
        return at, sizes

    def vote(self) -> tuple[int, float] | None:
        """The path of the main container and its share of the page's text."""
        own, sizes = self.main()
        return None if own is None else (self.paths[own], sizes[own] / sizes[0])

    def candidates(self) -> dict[int, float]:
        """The paths of all containers with text, with the share of the main container's text they hold."""
        own, sizes = self.main()
        if own is None:
            return {}
        inside = [False] * len(self.tags)
        shares: dict[int, float] = {}
        for i, parent in enumerate(self.parents):
            inside[i] = i == own or (parent >= 0 and inside[parent])
            if sizes[i] and self.tags[i] in _CONTAINER and not self.apart[i]:
                held = sizes[i] / sizes[own] if inside[i] else 0.0
                shares[self.paths[i]] = min(1.0, shares.get(self.paths[i], 0.0) + held)
        at = own
        while at >= 0:
            if self.tags[at] in _CONTAINER:
                shares[self.paths[at]] = 1.0
            at = self.parents[at]
        return shares

    def extract(self, chosen: int | None) -> str:
        """The text below the path with the hash ``chosen`` if there is any; else below the page's main container."""
        if chosen is not None:
            if text := self._below({i for i, p in enumerate(self.paths) if p == chosen and not self.apart[i]}):
                return text
        own, _ = self.main()
        return "" if own is None else self._below({own})

    def _below(self, roots: set[int]) -> str:
        if not roots:
            return ""
        inside = [False] * len(self.tags)
        for i, parent in enumerate(self.parents):
            inside[i] = i in roots or (parent >= 0 and inside[parent])
        # A reference does not reach from one element into another.
        parts = [html.unescape(text) if inside[at] and not self.apart[at] else " " for at, text in self.pieces]
        return " ".join("".join(parts).split())


def host(url: Column) -> Column:
    """The host of a url in lower case, without user and port; empty for anything else."""
    authority = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*@)?([^/?#:]*)", 1)
    return authority


def path_step(above: int, label: str) -> int:
    """The path of an element from its parent's: a running hash, so depth costs nothing."""
    digest = xxhash.xxh64_intdigest(label.encode("utf-8", "surrogatepass"), above & (1 << 64) - 1)
    return digest - (1 << 64) if digest >> 63 else digest


def _with_keys(pages: DataFrame) -> DataFrame:
    return pages.select("*", host(F.col("url")).alias("_host"), F.xxhash64("html").alias("_page"))


def candidates(pages: DataFrame) -> DataFrame:
    """host, page, path, share and vote (zero but for the main container's path) of the paths of all pages with a host."""

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            rows = []
            for name, key, source in zip(*(frame.column(c).to_pylist() for c in ("_host", "_page", "html")), strict=True):
                page = Page(source or "")
                cast = page.vote()
                for path, share in page.candidates().items():
                    rows.append((name, key, path, share, cast[1] if path == cast[0] else 0.0))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["host", "page", "path", "share", "vote"]
            )

    asked = _with_keys(pages.select("url", "html")).filter("_host <> ''").select("_host", "_page", "html")
    return map_batches(asked, batches, "host string, page long, path long, share double, vote double")


def consensus(found: DataFrame) -> DataFrame:
    """host, page and the path chosen for the page; pages that keep their own main container are left out."""
    # Repeated pages vote once; whole numbers add up alike in any order.
    cast = found.filter("vote > 0").groupBy("host", "page", "path").agg(F.max("vote").alias("vote"))
    voted = stage(
        cast.groupBy("host", "path").agg(
            F.sum(F.round(F.col("vote") * 1e6).cast("long")).alias("votes"), F.count("*").alias("voters")
        ),
        "voted",
    )
    hosts = voted.groupBy("host").agg(F.sum("votes").alias("all_votes"), F.sum("voters").alias("all_voters"))
    # Paths one page alone has voted for choose nothing.
    shared = voted.filter("voters > 1").join(hosts, "host")
    met = found.join(shared, ["host", "path"]).select(
        "host", "page", F.struct("votes", "path").alias("choice"),
        (F.col("share") >= COVERS).alias("covers"),
        ((2 * F.col("votes") > F.col("all_votes")) & (F.col("all_voters") > 2)).alias("leads"),
    )
    best = met.groupBy("host", "page").agg(
        F.max(F.when(F.col("covers"), F.col("choice"))).alias("covering"),
        F.max(F.when(F.col("leads"), F.col("choice"))).alias("leading"),
    )
    chosen = F.coalesce(F.col("covering.path"), F.col("leading.path"))
    return best.select("host", "page", chosen.alias("chosen")).filter("chosen IS NOT NULL")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    won = consensus(stage(candidates(pages), "candidates"))
    asked = _with_keys(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")).join(
        won.withColumnsRenamed({"host": "_host", "page": "_page"}), ["_host", "_page"], "left"
    ).select("page_id", "url", "html", "chosen")

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            texts = [
                Page(source or "").extract(chosen)
                for source, chosen in zip(frame.column("html").to_pylist(), frame.column("chosen").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    frame.column("page_id"), frame.column("url"), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return map_batches(asked, batches, "page_id long, url string, text string, n_chars long")
