"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one for each block of the page. A line's length counts the characters of its text that are
not in links (headings count theirs), and lengths are summed over sliding windows of ``window`` lines on every page.
Lines whose windows are not empty form runs: a run starts at the surge point, where a window's sum leaves nothing, and ends at the dive point, where
windows of lines sum to nothing again, as in a menu of links. A run stays, its short lines too, if one of its sums is over ``surge``; between a run's first and last
line with a length nothing is dropped. A page without such a run gives all its lines that have a length.

Article and main elements weigh, but don't replace the windows: where they hold at least half of the page's text, the
windows run over their lines only and every run in them stays, whatever its sums; where they hold less (a teaser beside
the body), they count as any other element.

Elements that by name, or by a class, id or role, are menus, headers, footers, sidebars, notices, adverts, forms or
comments are left out. A mark is a whole word ("sidebar"), its last part ("cookie-notice") or its first with a container
behind it ("ad-slot"); "has-sidebar", "no-sidebar" and the like mark nothing, and headers inside an article are part of
it. An element that holds over half of the page's text stays nevertheless, unless it is named as comments or the page
has an article outside it.

Null or empty html, and pages with no text, give "" and 0. Unclosed elements end where their parent ends; an unclosed
script, style or frame ends at the next tag, an unclosed comment at the page's end. Tags without an end are text. Time
is linear in the page's length. Repeated rows are extracted each for itself, an empty table gives no rows, and other
columns of the table, of any name, don't matter.
"""

from __future__ import annotations

import html as _html
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

WINDOW = 3
SURGE = 86

# Element names of HTML and the words by which pages mark what is not their main text.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript"}
SKIPPED = {"select", "button", "dialog", "template", "svg", "canvas", "object", "audio", "video", "head", "datalist", "math"}
ASIDE = {"nav", "footer", "aside", "menu", "form"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "input"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
IN_HEAD = {"meta", "title", "link", "script", "style", "base", "noscript", "template"}
MARKED = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "sidebar", "side", "comment", "comments", "commentlist", "disqus", "respond", "reply", "replies", "notice", "notices", "cookie", "cookies", "consent", "gdpr", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "signup", "login", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "pagination", "pager", "footer", "foot", "header", "masthead", "topbar", "toolbar", "share", "sharing", "social", "related", "recommended", "widget", "skip", "search", "complementary", "contentinfo", "searchbox"}
COMMENTS = {"comment", "comments", "commentlist", "disqus", "respond", "reply", "replies"}
HEADERS = {"header", "masthead", "banner"}
UNMARKED_BY = {"has", "no", "with", "without", "not", "non", "hide", "hidden", "show"}
CONTAINERS = {"area", "bar", "block", "body", "bottom", "box", "button", "buttons", "center", "column", "container", "content", "form", "group", "holder", "icons", "inner", "item", "items", "left", "link", "links", "list", "main", "media", "module", "outer", "panel", "right", "section", "slot", "space", "text", "top", "unit", "wrap", "wrapper", "zone"}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r""">|=\s*(["'])""")
_ATTRS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_NEXT_TAG = re.compile(r"<[a-zA-Z/!?]")


def _mark(attrs: str, in_article: bool) -> str:
    """The word by which a class, id or role marks an element, or ""."""
    for m in _ATTRS.finditer(attrs):
        for word in (m[1] or m[2] or m[3] or "").split():
            parts = [p for x in re.split(r"[-_]+", _HUMP.sub("-", word).lower()) if (p := x.rstrip("0123456789"))]
            if not parts or UNMARKED_BY.intersection(parts):
                continue
            found = parts[-1] if parts[-1] in MARKED else parts[0] if parts[0] in MARKED and all(p in CONTAINERS or p in MARKED for p in parts[1:]) else ""
            if found and not (in_article and found in HEADERS):
                return found
    return ""


class _Page:
    """One pass over a page: lines as lists of (raw text, innermost mark, in a link), and the tree of marked elements."""

    def __init__(self, page: str):
        self.lines: list[tuple[list[tuple[str, int, bool]], bool, bool]] = []  # parts, in an article, heading
        self.parts: list[tuple[str, int, bool]] = []
        #: Of each marked element, from 1 on: the mark around it, whether it goes whatever it holds, its text's size, whether it holds an article.
        self.parent, self.always, self.size, self.holds = [0], [False], [0], [False]
        self.stack: list[tuple[str, int]] = []  # name, mark inside it
        self.open: dict[str, list[int]] = {}
        self.mark = self.in_article = 0
        self.articles = 0
        self._read(page)
        self._flush()
        for i in range(len(self.size) - 1, 0, -1):
            self.size[self.parent[i]] += self.size[i]
            self.holds[self.parent[i]] |= self.holds[i]

    def _flush(self) -> None:
        if self.parts:
            self.lines.append((self.parts, self.in_article > 0, any(self.open.get(h) for h in HEADINGS)))
            self.parts = []

    def _text(self, raw: str) -> None:
        if raw and not (self.mark and self.always[self.mark]):
            linked = bool(self.open.get("a"))
            self.parts.append((raw, self.mark, linked))
            if not linked:
                self.size[self.mark] += len(raw.strip())

    def _pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            name, self.mark = self.stack.pop()
            self.open[name].pop()
            self.in_article -= name in ("article", "main")

    def _push(self, name: str, attrs: str) -> None:
        self.open.setdefault(name, []).append(len(self.stack))
        self.stack.append((name, self.mark))  # the mark to return to
        if name in ("article", "main"):
            self.in_article += 1
            self.articles += 1
            self.holds[self.mark] = True
        if name in ("html", "body", "article", "main"):
            return
        always = name in SKIPPED
        word = "" if always else name if name in ASIDE or name == "header" and not self.in_article else _mark(attrs, self.in_article > 0)
        if always or word:
            self.parent.append(self.mark)
            self.always.append(always or word in COMMENTS or self.always[self.mark])
            self.size.append(0)
            self.holds.append(False)
            self.mark = len(self.parent) - 1

    def _read(self, page: str) -> None:
        pos, n, last = 0, len(page), page.rfind(">")
        quotes, unclosed, no_comment_end = True, set(), False
        ends = {q: page.rfind(q) for q in "\"'"}
        begin = 0  # of text not yet taken
        while (at := page.find("<", pos, last + 1)) >= 0:
            pos = at + 1
            if page.startswith("!--", pos):
                self._text(page[begin:at])
                end = -1 if no_comment_end else page.find("-->", pos + 1)
                no_comment_end = end < 0
                begin = pos = n if end < 0 else end + 3
                continue
            closing = page.startswith("/", pos)
            name = _NAME.match(page, pos + closing)
            if not name:
                if page[pos : pos + 1] in ("!", "?", "/"):
                    self._text(page[begin:at])
                    begin = pos = page.find(">", pos) + 1
                continue
            end = -1
            if quotes and not closing:
                i = name.end()
                while m := _STOP.search(page, i):
                    if not m[1]:
                        end = m.end()
                        break
                    q = page.find(m[1], m.end()) if m.end() <= ends[m[1]] else -1
                    i = m.end() if q < 0 else q + 1
                quotes = end >= 0  # no end outside of quotes: from here on they don't count
            if end < 0:
                end = page.find(">", name.end() - 1) + 1
            self._text(page[begin:at])
            begin = pos = end
            word = name[0].lower()
            if closing:
                self._close(word)
            else:
                begin = pos = self._start(word, page[name.end() : end], page, end, unclosed)
        self._text(page[begin:] if begin < n else "")

    def _close(self, name: str) -> None:
        if name not in INLINE:
            self._flush()
        if self.open.get(name):
            self._pop_to(self.open[name][-1])

    def _start(self, name: str, attrs: str, page: str, end: int, unclosed: set[str]) -> int:
        """Takes in a start tag; gives the place where reading goes on."""
        block = name not in INLINE
        if self.open.get("head") and name not in IN_HEAD:
            self._pop_to(self.open["head"][-1])
        if block:
            self._flush()
        elif name == "br":
            self._text(" ")
        if name in RAW:
            close = None if name in unclosed else re.compile(rf"</{name}\b", re.I).search(page, end)
            if close:
                return page.find(">", close.end()) + 1 or len(page)
            unclosed.add(name)
            following = _NEXT_TAG.search(page, end)
            return following.start() if following else len(page)
        if name in VOID or attrs.endswith("/>"):
            return end
        if block and (p := self.open.get("p")) and p[-1] >= len(self.stack) - 8:  # a block ends an open paragraph
            self._pop_to(p[-1])
        if name == "li" and self.stack and self.stack[-1][0] == "li":
            self._pop_to(len(self.stack) - 1)
        self._push(name, attrs)
        return end


def lines_of(page: str) -> list[tuple[str, int, bool]]:
    """(text, length, in an article) of each line that is not empty or left out by an element around it."""
    read = _Page(page)
    left_out = [False] * len(read.parent)
    for i in range(1, len(left_out)):
        most = 2 * read.size[i] > read.size[0] and (read.holds[i] or not read.articles)
        left_out[i] = left_out[read.parent[i]] or read.always[i] or not most
    out = []
    for parts, in_article, heading in read.lines:
        parts = [p for p in parts if not left_out[p[1]]]
        line = " ".join(_html.unescape("".join([p[0] for p in parts])).split())
        if line:
            linked = [p[0] for p in parts if p[2]]
            links = 0 if heading or not linked else len(" ".join(_html.unescape("".join(linked)).split()))
            out.append((line, max(0, len(line) - links), in_article))
    return out


def window_sums(size: list[int], window: int) -> list[int]:
    """Of each line on, the sum of the lengths of ``window`` lines, fewer at the end."""
    total = [0]
    for s in size:
        total.append(total[-1] + s)
    n = len(size)
    return [total[min(n, i + window)] - total[i] for i in range(n)]


def blocks(size: list[int], window: int, surge: int) -> list[tuple[int, int]]:
    """(first line, line behind the last) of the runs between a surge and a dive point: lines with a length, less than ``window`` others in a row between them, and a sum over ``surge``."""
    sums, out, start, last, most = window_sums(size, window), [], -1, -1, 0
    for i, s in enumerate([*sums, 0]):
        if s == 0:
            if start >= 0 and most > surge:
                out.append((start, last + 1))
            start, most = -1, 0
            continue
        if size[i]:
            start = i if start < 0 else start
            last = i
        if start >= 0:
            most = max(most, s)
    return out


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    lines = lines_of(page or "")
    inside = sum(len(line) for line, _, a in lines if a)
    if inside and 2 * inside >= sum(len(line) for line, _, _ in lines):
        lines, surge = [x for x in lines if x[2]], 0
    found = blocks([length for _, length, _ in lines], window, surge)
    if found:
        return "\n".join([line for a, b in found for line, _, _ in lines[a:b]])
    return "\n".join([line for line, length, _ in lines if length])


def extract_text(pages: DataFrame, *, id_cols: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """Per row: its id columns, the main text and its length in code points. No shuffle."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*id_cols).schema)

    def f(*columns):
        texts = [main_text(x) for x in columns[-1]]
        return *columns[:-1], texts, [len(t) for t in texts]

    return arrow_map(pages.select(*id_cols, F.col(html_col).cast("string")), f, f"{kinds}, text string, n_chars long")
