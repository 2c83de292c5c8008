"""HTML extraction by consensus host paths.

Each page is read once into blocks of text and the elements they stand in. Containers are scored:
a block gives its characters outside links to the element around it and half of them to the next
one out. The page's best container votes, under its generalised path (tags with their classes, digits and
positions left out), for its host. Spark counts the votes and picks each host's winning path; then
every page is read again and its text is what stands in the elements of that path, with the whole article around
each of them and the page's best container if that is around one of them and not the whole body. A page without
that path, or with less than ``MIN_SHARE`` of its best container's text there, uses its own best one.

An article outside of ``article`` and ``main`` may stand in several containers side by side. Those next to a page's best one
that hold ``MIN_SHARE`` of its text or more vote too; the paths that do so on half of the pages
that voted for the winning one are read with it.

Left out everywhere: scripts, styles, menus, asides, footers, forms and the like by tag, and adverts, notices,
sidebars, reader comments and the like by class or id; a header only outside of an article.
An article inside an element that merely looks like an advert (one that was never closed) counts.

Votes are summed in each task before the shuffle. The winning paths, one for each host, are
broadcast up to ``BROADCAST_HOSTS`` hosts and joined by a shuffle beyond.

Defined cases: null and empty pages give an empty text; a null url is of the host ''; of equally good
containers and paths the first in the page and in the alphabet win; a page cut off in mid-tag loses
that tag only; repeated rows are extracted each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetscape.llm.graph import written

MIN_SHARE = 0.25
BROADCAST_HOSTS = 50_000
OUT = "page_id long, url string, text string, n_chars long"

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPLIT = re.compile(r"[^a-z]+")

# Fixed sets of HTML's tags.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
LEFT_OUT = frozenset("script style noscript template iframe object svg canvas nav menu aside footer form button select textarea input dialog head title audio video noembed noframes".split())
CONTAINERS = frozenset("article main section div td body center blockquote html".split())
#: Tags that an opening tag of the same set closes, up to the enclosing element named last.
SIBLINGS = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}), "tr": ("tr td th", {"table"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}), "option": ("option", {"select"})}
#: Words in classes and ids of what isn't part of the article, and of comments.
BOILER = frozenset("ad ads advert advertisement advertising adbox adslot banner sponsor sponsored promo promotion cookie cookies consent notice notices notification alert gdpr sidebar aside widget share sharing social related recommended breadcrumb breadcrumbs menu nav navbar navigation footer masthead newsletter subscribe subscription signup login search popup modal overlay pagination pager toolbar skip hidden copyright disclaimer outbrain taboola".split())
COMMENTS = frozenset("comment comments commentlist respond reply replies disqus discussion reactions".split())
HINTS = frozenset("article content entry post story text body main".split())


class Page:
    """Elements (parent, tag, path) and blocks (text, element, characters in links) of a page."""

    def __init__(self, html: str) -> None:
        self.parent, self.tag, self.path, self.hint = [-1], ["#"], [""], [False]
        self.blocks: list[tuple[str, int, int]] = []
        self._text: list[str] = []
        self._linked = 0
        # open elements: (tag, element, left out: 0 no, 1 by a look like an advert, 2 for good, in a link)
        stack: list[tuple[str, int, int, bool]] = [("#", 0, 0, False)]
        at, end = 0, len(html)
        while at < end:
            lt = html.find("<", at)
            if lt < 0:
                self._add(html[at:], stack[-1])
                break
            if lt > at:
                self._add(html[at:lt], stack[-1])
            m = _TAG.match(html, lt)
            if m is None:
                self._add("<", stack[-1])
                at = lt + 1
                continue
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue
            if m[1] or m[4]:
                self._close(name, stack)
                continue
            self._open(name, m[3] or m[6] or "", stack)
            if name in RAW and stack[-1][0] == name:
                stop = re.compile(rf"</{name}\b[^>]*>", re.I).search(html, at)
                at = stop.end() if stop else end
                stack.pop()
        self._flush(stack)

    def _add(self, text: str, top: tuple) -> None:
        if not top[2]:
            self._text.append(text)
            if top[3]:
                self._linked += len(text)

    def _flush(self, stack: list) -> None:
        if self._text:
            text = " ".join(unescape("".join(self._text)).split())
            if text:
                self.blocks.append((text, stack[-1][1], self._linked))
            self._text, self._linked = [], 0

    def _open(self, name: str, attributes: str, stack: list) -> None:
        if name == "br":
            self._text.append(" ")
            return
        if name not in INLINE:
            self._flush(stack)
            if name in SIBLINGS:
                close, bound = SIBLINGS[name]
                self._unwind(stack, close.split(), bound)
            self._unwind(stack, ["p"], {"article", "section", "div", "td", "li", "body", "main", "aside", "nav", "form"} if name != "p" else {"article", "section", "div", "td", "li", "body", "main", "blockquote"})
        if name in VOID:
            return
        tag, element, out, link = stack[-1]
        words: list[str] = []
        classes = ""
        if attributes:
            for a in _ATTRIBUTE.finditer(attributes):
                value = (a[2] or a[3] or a[4] or "").lower()
                key = a[1].lower()
                if key == "hidden" or key == "aria-hidden" and value == "true":
                    out = 2
                elif key in ("class", "id", "role"):
                    found = [w for w in _SPLIT.split(value) if w]
                    words += found
                    if key == "class":
                        classes = "." + ".".join(sorted(set(found))) if found else ""
        inside = name in ("article", "main")
        if inside and out == 1:
            out = 0
        if name in LEFT_OUT or COMMENTS.intersection(words):
            out = 2
        elif name == "header" and not any(x[0] in ("article", "main") for x in stack):
            out = max(out, 2)
        elif name not in ("body", "html") and BOILER.intersection(words) and not inside:
            out = max(out, 1)
        if name not in INLINE:
            self.parent.append(element)
            self.tag.append(name)
            self.path.append(f"{self.path[element]}>{name}{classes}")
            self.hint.append(inside or bool(HINTS.intersection(words)))
            element = len(self.tag) - 1
        stack.append((name, element, out, link or name == "a"))

    def _unwind(self, stack: list, names: list[str], bound: set) -> None:
        """Close the innermost open element of ``names``, and what is open in it, unless one of ``bound`` is further in."""
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                del stack[k:]
                return
            if stack[k][0] in bound:
                return

    def _close(self, name: str, stack: list) -> None:
        if name == "br":
            self._text.append(" ")
            return
        if name == "p" or name not in INLINE:
            self._flush(stack)
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] == name:
                del stack[k:]
                return
            if name in INLINE and stack[k][0] not in INLINE:
                return

    def around(self, element: int) -> int:
        """The innermost container at or above an element."""
        while element > 0 and self.tag[element] not in CONTAINERS:
            element = self.parent[element]
        return element

    def scores(self) -> Counter:
        score: Counter = Counter()
        for text, element, linked in self.blocks:
            plain = max(0, len(text) - linked)
            c = self.around(element)
            if plain and c:
                score[c] += plain * (1.25 if self.hint[c] else 1)
                outer = self.around(self.parent[c])
                if outer:
                    score[outer] += plain / 2
        return score

    def best(self) -> int:
        """The best container; 0 if there is none."""
        score = self.scores()
        return min(score, key=lambda e: (-score[e], e)) if score else 0

    def inside(self, chosen: set[int]) -> list[str]:
        out = []
        for text, element, _ in self.blocks:
            while element > 0 and element not in chosen:
                element = self.parent[element]
            if element in chosen:
                out.append(text)
        return out

    def above(self, element: int) -> Iterator[int]:
        """The element and all around it."""
        while element > 0:
            yield element
            element = self.parent[element]

    def article(self, element: int) -> int:
        """The innermost article at or above an element, or the element itself."""
        return next((e for e in self.above(element) if self.tag[e] == "article"), element)

    def beside(self, best: int) -> list[int]:
        """The containers next to the best one that hold much of the text, unless an article's own tag bounds it."""
        if any(self.tag[e] in ("article", "main") for e in self.above(best)):
            return []
        plain = [0] * len(self.tag)
        for text, element, linked in self.blocks:
            plain[element] += max(0, len(text) - linked)
        for e in range(len(plain) - 1, 0, -1):  # an element comes after its parent
            plain[self.parent[e]] += plain[e]
        least = max(1, MIN_SHARE * plain[best])
        return [e for e in range(1, len(plain)) if self.parent[e] == self.parent[best] and e != best and self.tag[e] in CONTAINERS and plain[e] >= least]

    def extract(self, path: str | None, others: list[str] | None = None) -> str:
        own = self.best()
        chosen = {self.article(own), *(self.beside(own) if own else ())}  # element 0 holds every block
        if path:
            agreed = {e for e, p in enumerate(self.path) if p == path}
            text = self.inside(agreed)
            if sum(map(len, text)) >= MIN_SHARE * sum(map(len, self.inside({own}))) and text:
                # a best container around the path's elements has text of the same article beside them
                # (the body is around everything, so it says nothing of that kind)
                around = {own} if self.tag[own] not in ("body", "html") and any(own in self.above(e) for e in agreed) else set()
                beside = {e for e, p in enumerate(self.path) if p in others} if others else set()
                chosen = {self.article(e) for e in agreed} | around | beside
        return "\n\n".join(self.inside(chosen))


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    votes: Counter = Counter()
    for b in batches:
        for host, html in zip(b.column("host").to_pylist(), b.column("html")):
            page = Page(html.as_py() or "")
            if best := page.best():
                votes[host, page.path[best], ""] += 1
                for other in {page.path[e] for e in page.beside(best)} - {page.path[best]}:
                    votes[host, page.path[best], other] += 1
    rows = [(*key, n) for key, n in votes.items()]
    for k in range(0, len(rows), 10_000):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + 10_000]), [pa.string(), pa.string(), pa.string(), pa.int64()])], names=["host", "path", "other", "n"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [Page(html.as_py() or "").extract(path, others) for html, path, others in zip(b.column("html"), b.column("path").to_pylist(), b.column("others").to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, others): the path with the most votes of each host's pages, and the paths that stand beside it on half
    of the pages that voted for it."""
    votes = _with_host(pages).select("host", "html").mapInArrow(_vote, "host string, path string, other string, n long")
    counted = votes.groupBy("host", "path", "other").agg(F.sum("n").alias("n"))
    by_path = counted.groupBy("host", "path").agg(
        F.max(F.when(F.col("other") == "", F.col("n"))).alias("n"), F.array_sort(F.collect_list(F.when(F.col("other") != "", F.struct("other", "n")))).alias("beside")
    )
    top = by_path.groupBy("host").agg(F.min(F.struct((-F.col("n")).alias("n"), "path", "beside")).alias("top"))
    return top.select("host", "top.path", F.expr("transform(filter(top.beside, b -> 2 * b.n >= -top.n), b -> b.other)").alias("others"))


def _with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^[^:/?#]+://(?:[^/?#@]*@)?([^:/?#]+)", 1))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host.alias("host"))


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    paths = written(host_paths(pages), "paths")
    small = paths.count() <= BROADCAST_HOSTS
    joined = _with_host(pages).join(F.broadcast(paths) if small else paths, "host", "left")
    return joined.select("page_id", "url", "html", "path", "others").mapInArrow(_extract, OUT)
