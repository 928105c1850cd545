"""Blocks of text of an HTML page: a tolerant tag reader that keeps the path of open elements."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import xxhash

#: Elements without content, elements that stay inside a line, and elements that end
#: an open element of their own kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp "
                    "small span strike strong sub sup time tt u var wbr").split())
ENDS_OWN_KIND = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                 "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"}}
STOPS = frozenset("ul ol dl table tbody thead tfoot article section div main body html select".split())

#: Elements that hold no text of the page, and elements that stand beside the article.
NO_TEXT = frozenset("script style noscript template iframe svg canvas object head title button select textarea".split())
BESIDE = frozenset("form nav aside footer dialog menu".split())
#: Words in a class, id or role that mark what is not the article, unless another word of the same name
#: says that it is about a state.
NOT_ARTICLE = frozenset((
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "alert popup modal overlay newsletter subscribe signup login social share sharing sidebar widget related recommended "
    "comment comments disqus respond reply replies menu nav navbar navigation breadcrumb breadcrumbs masthead footer copyright "
    "pagination pager toolbar skip").split())
STATES = frozenset("has no not with without is open opened closed off on hide hidden show".split())
#: Site headers are left out, an article's own header holds its title.
HEADERS = frozenset(["header", "topbar"])
ARTICLE = frozenset(["article", "main"])
#: Elements that no name marks.
WHOLE = frozenset(["html", "body", "main"])

#: What is passed over up to its end tag, or the end of the page.
RAW = frozenset("script style noscript template iframe textarea svg title".split())
TAG = re.compile(r"<(/?)([a-z][^\s/>]*)", re.I)
MARK = re.compile(r"""[>"']""")
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)


class Element:
    __slots__ = ("article", "block", "drop", "exempt", "inline", "kids", "kind", "marked", "open_inline", "path", "skip", "tag", "up")

    def __init__(self, tag: str, inline: bool, up: Element | None, label: str, kind: bool, marked: bool):
        self.tag, self.inline, self.up, self.kind, self.marked = tag, inline, up, kind, marked
        self.article = tag in ARTICLE or (up is not None and up.article)
        self.block = up.block if inline and up else self
        self.path = self.block.path if inline and up else hash64(f"{up.block.path}/{label}") if up else 0
        self.skip = up is not None and up.skip        # inside what holds no text
        self.drop = self.exempt = False
        self.kids: list[str] = []
        self.open_inline: dict[str, int] = {}


def named(names: str, in_article: bool) -> bool:
    """Whether a class, id or role says that an element is no part of the article."""
    for name in names.split():
        words = {w.lower() for w in re.split(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])", name)}
        if not words & STATES and (words & NOT_ARTICLE or (not in_article and words & HEADERS)):
            return True
    return False


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, tag, rest) for texts ('text'), start tags ('start') and end tags ('end'), in time linear in the page.

    A `>` inside quotes does not end a tag. Once a quote is never closed, quotes are plain characters up to the end
    of the page, so no part of it is read again and again.
    """
    at = done = 0                        # html[done:at] is text that was not handed out
    quotes = True
    lower = ""
    gt = html.find(">")                  # the next ">" from here
    while True:
        at = html.find("<", at)
        if at >= 0 and 0 <= gt < at:
            gt = html.find(">", at)
        if at < 0 or gt < 0:                          # no tag can end here
            if html.startswith("<!--", at) and at >= 0:
                yield "text", "", html[done:at]
                return
            break
        m = TAG.match(html, at)
        if m is None:
            if html.startswith("<!--", at):
                end = html.find("-->", at)
                end = len(html) if end < 0 else end + 3
            elif html[at + 1:at + 2] in ("!", "?", "/"):
                end = gt + 1
            else:
                at += 1
                continue
            yield "text", "", html[done:at]
            at = done = end
            continue
        end = i = m.end()
        if quotes:
            while True:
                q = MARK.search(html, i)
                if q is None or q[0] == ">":
                    end = q.start() if q else -1
                    break
                i = html.find(q[0], q.end()) + 1
                if not i:
                    end = -1
                    break
            quotes = end >= 0
        if not quotes or end < 0:
            end = html.find(">", m.end())
        tag, rest = m[2].lower(), html[m.end():end]
        yield "text", "", html[done:at]
        at = done = end + 1
        if tag in RAW and not m[1]:
            lower = lower or html.lower()
            close = lower.find(f"</{tag}", at) if len(lower) == len(html) else html.find(f"</{tag}", at)
            gone = html.find(">", close) if close >= 0 else -1
            at = done = gone + 1 if gone >= 0 else len(html)
            continue
        yield ("end" if m[1] else "start"), tag, rest
    if done < len(html):
        yield "text", "", html[done:]


class Page:
    """The blocks of a page, (path, inside an article, text), and its containers, (path, kinds of children).

    What stands beside the article goes by the kinds and names of its elements, but no kind or name drops an article
    or what holds it: see `settle`.
    """

    def __init__(self, html: str):
        root = Element("", False, None, "", False, False)
        self.open, self.elements, self.text = [root], [root], []
        self.found: list[tuple[Element, str]] = []
        self.opened: dict[str, int] = {}
        for kind, tag, rest in tokens(html):
            if kind == "text":
                self.chars(rest)
            elif kind == "start":
                self.start(tag, rest)
            else:
                self.end(tag)
        while self.open:
            self.pop()
        self.settle()
        self.blocks = [(e.path, e.article, t) for e, t in self.found if not e.drop]
        self.containers = [(e.path, " ".join(e.kids)) for e in self.elements if e.kids and not e.inline and not e.drop]
        self.parents = {e.path: e.up.block.path if e.up else 0 for e, _ in self.found if not e.drop}

    def settle(self) -> None:
        """Drop what is marked, with all below it.

        A form that holds an article not itself marked is a wrapper. Where no article or main element is free of marks
        on itself and above, those with the fewest are the article, and they and what holds them are exempt. A page
        without either, of which nothing would be left, keeps what only names have marked.
        """
        articles = [e for e in self.elements if e.tag in ARTICLE and not e.skip]
        for a in articles:
            e = a.up
            while not a.marked and e is not None and not (e.tag == "form" and e.exempt):
                e.exempt = e.exempt or (e.tag == "form" and e.kind)
                e = e.up
                if e is not None and e.tag in ARTICLE:
                    break
        marks: dict[Element, int] = {}
        for e in self.elements:
            marks[e] = (marks[e.up] if e.up else 0) + ((e.kind or e.marked) and not e.exempt)
        if articles and min(marks[a] for a in articles):
            pool = [a for a in articles if a.tag == "article"] or articles
            least = min(marks[a] for a in pool)
            for a in pool:
                e = a if marks[a] == least else None
                while e is not None and not (e.exempt and e.tag not in ("form",)):
                    e.exempt = True
                    e = e.up
        self._drop(names=True)
        if not articles and not any(not e.drop for e, _ in self.found):
            self._drop(names=False)

    def _drop(self, names: bool) -> None:
        for e in self.elements:
            own = (e.kind or (names and e.marked)) and not e.exempt
            e.drop = own or (e.up is not None and e.up.drop)

    def chars(self, s: str) -> None:
        if s and not self.open[-1].skip:
            self.text.append(s)

    def flush(self) -> None:
        """End the block that is being read."""
        if self.text:
            text = " ".join(unescape("".join(self.text)).split())
            if text:
                self.found.append((self.open[-1].block, text))
            self.text = []

    def pop(self) -> None:
        e = self.open[-1]
        if not e.inline:
            self.flush()
        else:
            e.block.open_inline[e.tag] -= 1
        if e.tag:
            self.opened[e.tag] -= 1
        self.open.pop()

    def close_to(self, i: int) -> None:
        while len(self.open) > i:
            self.pop()

    def start(self, tag: str, rest: str) -> None:
        if tag in VOID:
            if tag in INLINE:
                self.chars(" " if tag in ("br", "wbr") else "")
            else:
                self.flush()
            return
        inline = tag in INLINE
        if not inline:
            kinds = ENDS_OWN_KIND.get(tag, {"p"})
            if any(self.opened.get(k) for k in (*kinds, "p")):
                for i in range(len(self.open) - 1, 0, -1):
                    t = self.open[i].tag
                    if t in kinds or (t == "p" and tag != "p"):
                        self.close_to(i)
                        break
                    if t in STOPS:
                        break
            self.flush()
        if rest and rest.rstrip().endswith("/") and tag in ("svg", "path"):
            return
        up = self.open[-1]
        found = NAMES.findall(rest) if rest else []
        names = " ".join(v.strip("\"'") for _, v in found)
        first = next((v.strip("\"'") for k, v in found if k.lower() == "class"), "")
        label = f"{tag}.{'.'.join(first.split())}" if first else tag
        kind = tag in BESIDE or (tag in HEADERS and not up.article)
        marked = tag not in WHOLE and named(names, up.article)
        e = Element(tag, inline, up, label, kind and not inline, marked and not inline)
        e.skip = e.skip or tag in NO_TEXT or (inline and marked)
        if inline:
            e.block.open_inline[tag] = e.block.open_inline.get(tag, 0) + 1
        else:
            up.block.kids.append(tag)
        self.opened[tag] = self.opened.get(tag, 0) + 1
        self.open.append(e)
        self.elements.append(e)

    def end(self, tag: str) -> None:
        if not self.opened.get(tag) or (tag in INLINE and not self.open[-1].block.open_inline.get(tag)):
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                self.close_to(i)
                return
            if tag in ("p", "li", "td", "th", "tr", "dd", "dt") and self.open[i].tag in STOPS:
                return


def hash64(s: str) -> int:
    """A signed 64-bit hash, the same in every process."""
    h = xxhash.xxh64_intdigest(s)
    return h - (1 << 64) if h >> 63 else h


def features(page: Page) -> Iterator[tuple[int, int, int, bool]]:
    """(path, kind, feature, inside an article), each once a page; kind 0: content, 1: presentation."""
    found = {(p, 0, hash64(t), a) for p, a, t in page.blocks}
    found |= {(p, 1, hash64(kids), False) for p, kids in page.containers}
    return iter(found)
