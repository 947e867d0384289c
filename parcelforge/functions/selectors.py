"""CSS selectors over a page that is read once.

A selector is compiled to steps. The page becomes a list of its elements in document order, each with its parent, the
sibling before it and where its texts lie; as both come before the element, one walk along those that a step may name tells
which elements have come as far. Several selectors share the one reading.

Known are tags, ``*``, ``.class``, ``#id``, ``[attr]``, ``[attr=value]`` (also ``^= $= *= ~=``), ``:contains('text')`` (also as
``:-soup-contains``), ``:first-child``, descendants, children (``>``), the next sibling (``+``), later siblings (``~``) and lists
(``,``). Anything else raises ValueError.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate

# Elements without an end tag.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_TOKEN = re.compile(
    r"""(?P<comb>\s*[>+~]\s*|\s+)|(?P<tag>\*|[A-Za-z][\w-]*)|\.(?P<cls>-?[A-Za-z_][\w-]*)|\#(?P<id>[\w-]+)
    |\[\s*(?P<attr>[\w-]+)\s*(?:(?P<op>[~^$*]?=)\s*(?P<val>"[^"]*"|'[^']*'|[\w-]+)\s*)?\]|:(?:-soup-)?contains\(\s*(?P<text>"[^"]*"|'[^']*'|[^)'"]*?)\s*\)|:(?P<first>first-child)""",
    re.VERBOSE,
)
_OPS = {"=": lambda a, v: a == v, "^=": lambda a, v: bool(v) and a.startswith(v), "$=": lambda a, v: bool(v) and a.endswith(v), "*=": lambda a, v: bool(v) and v in a, "~=": lambda a, v: v in a.split()}


@dataclass
class Step:
    """What an element has to be, and how it stands to the one of the step before (``comb``)."""

    comb: str = " "
    tag: str | None = None
    id: str | None = None
    classes: list[str] = field(default_factory=list)
    attrs: list[tuple] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    first: bool = False


def _split(css: str) -> list[str]:
    """The parts of a list of selectors: commas within quotes, brackets and parentheses don't count."""
    out, depth, quote, start = [], 0, "", 0
    for k, ch in enumerate(css):
        if quote:
            quote = "" if ch == quote else quote
        elif ch in "\"'":
            quote = ch
        elif ch in "([":
            depth += 1
        elif ch in ")]":
            depth -= 1
        elif ch == "," and not depth:
            out.append(css[start:k])
            start = k + 1
    return [*out, css[start:]]


@lru_cache(maxsize=256)
def compiled(css: str) -> list[list[Step]]:
    """For each selector of a list its steps, from the outermost to the one for the element itself."""
    out = []
    for one in _split(css):
        text, at, steps, empty = one.strip(), 0, [Step()], True
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m or m.end() == at or (m["comb"] and empty) or (m["tag"] and not empty):
                raise ValueError(f"can't read the selector {css!r} at {text[at:]!r}")
            at, step, empty = m.end(), steps[-1], False
            unquoted = lambda x: x[1:-1] if x[:1] in ("'", '"') else x
            if m["comb"]:
                steps.append(Step(m["comb"].strip() or " "))
                empty = True
            elif m["tag"]:
                step.tag = None if m["tag"] == "*" else m["tag"].lower()
            elif m["cls"]:
                step.classes.append(m["cls"])
            elif m["id"]:
                step.id = m["id"]
            elif m["attr"]:
                step.attrs.append((m["attr"].lower(), m["op"], unquoted(m["val"] or "")))
            elif m["first"]:
                step.first = True
            else:
                step.texts.append(unquoted(m["text"]))
        if empty:
            raise ValueError(f"the selector {css!r} has an empty part")
        out.append(steps)
    return out


_PIECE = re.compile(r"<[^<>]*>|[^<]+")
_ATTRS = r"""(?:[ \t\n]+[A-Za-z][A-Za-z-]*(?:="[^"&]*"|='[^'&]*')?)*[ \t\n]*"""
_PLAIN = re.compile(rf"<(/?)([A-Za-z][A-Za-z0-9]*)({_ATTRS})>")
_ATTR = re.compile(r"""([A-Za-z][A-Za-z-]*)(?:="([^"]*)"|='([^']*)')?""")
# Elements whose content the parser reads in its own ways.
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext", "svg", "math"}


@lru_cache(maxsize=1 << 14)
def _plain_tag(markup: str) -> tuple[str, dict[str, str] | None] | None:
    """Name and attributes (null: an end tag) of a tag that is written plainly, null for any other."""
    m = _PLAIN.fullmatch(markup)
    if not m or m[2].lower() in _RAW or (m[1] and m[3]):
        return None
    attrs = {k.lower(): v or w or "" for k, v, w in reversed(_ATTR.findall(m[3]))}
    return m[2].lower(), None if m[1] else attrs


class Page(HTMLParser):
    """The elements of a page in document order. Of each: ``tags, attrs, parents, before`` (the sibling before, -1 where there is
    none), ``ends`` (the number after its last descendant), the range of its pieces of text, and its place in the page.

    A page of plain tags and texts is cut by one pattern, any other one goes through the parser, with the same elements."""

    def __init__(self, html: str):
        self.html = html.replace("\r\n", "\n").replace("\r", "\n") if "\r" in html else html
        self._empty()
        if not self._cut():
            super().__init__(convert_charrefs=True)
            self._empty()
            for line in self.html.split("\n"):  # as the parser counts them
                self.lines.append(self.lines[-1] + len(line) + 1)
            self.feed(self.html)
            self.close()
        while self.open:
            self._end(len(self.html))
        self.of_tag: dict[str, list[int]] = {}
        for e, tag in enumerate(self.tags):
            self.of_tag.setdefault(tag, []).append(e)
        self._whole: tuple[str, list[int]] | None = None

    def _empty(self) -> None:
        self.tags, self.attrs, self.parents, self.before, self.ends, self.first, self.last, self.starts, self.stops = [], [], [], [], [], [], [], [], []
        self.pieces, self.open, self.youngest, self.lines = [], [], {-1: -1}, [0]

    def _cut(self) -> bool:
        """Read a plain page; whether it is one."""
        found, at, size = _PIECE.findall(self.html), 0, len(self.html)
        for x in found:
            start, at = at, at + len(x)
            if x[0] != "<":
                if "&" in x:
                    if at == size:
                        return False
                    x = unescape(x)
                self.pieces.append(x)
            elif (told := _plain_tag(x)) is None:
                return False
            elif told[1] is not None:
                self._start(*told, start, at)
            else:
                self._close(told[0], start, at)
        return at == size

    def _place(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def _start(self, tag: str, attrs: dict[str, str], start: int, stop: int) -> None:
        parent, own = self.open[-1] if self.open else -1, len(self.tags)
        self.tags.append(tag)
        self.attrs.append(attrs)
        self.parents.append(parent)
        self.before.append(self.youngest.get(parent, -1))
        self.youngest[parent] = own
        self.ends.append(own + 1)
        self.first.append(len(self.pieces))
        self.last.append(len(self.pieces))
        self.starts.append(start)
        self.stops.append(stop)
        if tag not in VOID:
            self.open.append(own)

    def _close(self, tag: str, place: int, stop: int) -> None:
        if any(self.tags[e] == tag for e in reversed(self.open)):
            while self.tags[self.open[-1]] != tag:
                self._end(place)
            self._end(stop)

    def handle_starttag(self, tag, attrs):
        start = self._place()
        self._start(tag, {k: v or "" for k, v in reversed(attrs)}, start, start + len(self.get_starttag_text() or ""))

    def handle_endtag(self, tag):
        place = self._place()
        close = self.html.find(">", place)
        self._close(tag, place, len(self.html) if close < 0 else close + 1)

    def _end(self, place: int) -> None:
        e = self.open.pop()
        self.ends[e], self.last[e], self.stops[e] = len(self.tags), len(self.pieces), place

    def handle_data(self, data):
        if not (self.open and self.tags[self.open[-1]] in ("script", "style")):
            self.pieces.append(data)

    def _holds(self, e: int, text: str) -> bool:
        """Whether the text of an element, as it stands, has another in it."""
        if self._whole is None:
            self._whole = "".join(self.pieces), [0, *accumulate(map(len, self.pieces))]
        whole, at = self._whole
        return whole.find(text, at[self.first[e]], at[self.last[e]]) >= 0

    def text(self, e: int, sep: str = " ") -> str:
        """The pieces of an element's text, stripped, put together by ``sep``; white space within counts as one space."""
        return sep.join(x for x in (" ".join(p.split()) for p in self.pieces[self.first[e] : self.last[e]]) if x)

    def markup(self, e: int) -> str:
        return self.html[self.starts[e] : self.stops[e]]

    def _is(self, e: int, s: Step) -> bool:
        a = self.attrs[e]
        return (
            (s.id is None or a.get("id") == s.id)
            and (not s.classes or set(s.classes) <= set(a.get("class", "").split()))
            and all(n in a and (op is None or _OPS[op](a[n], v)) for n, op, v in s.attrs)
            and (not s.first or self.before[e] < 0)
            and all(self._holds(e, t) for t in s.texts)
        )

    def _next(self, done: list[int], comb: str, among: list[int]) -> list[int]:
        """Of ``among`` the elements that stand so to one of ``done``; both are in document order."""
        if comb in (">", "+"):
            known, link = set(done), self.parents if comb == ">" else self.before
            return [e for e in among if link[e] in known]
        if comb == "~":
            least: dict[int, int] = {}
            for d in done:
                least.setdefault(self.parents[d], d)
            return [e for e in among if least.get(self.parents[e], e) < e]
        # Elements lie within or apart from one another, so the farthest end of what began before tells.
        out, far, k = [], -1, 0
        for e in among:
            while k < len(done) and done[k] < e:
                far, k = max(far, self.ends[done[k]]), k + 1
            if e < far:
                out.append(e)
        return out

    def select(self, css: str) -> list[int]:
        """The elements that a selector names, in document order."""
        found: set[int] = set()
        for steps in compiled(css):
            done: list[int] = []  # elements that the steps so far end at
            for k, s in enumerate(steps):
                among = list(range(len(self.tags))) if s.tag is None else self.of_tag.get(s.tag, [])
                done = [e for e in (among if k == 0 else self._next(done, s.comb, among)) if self._is(e, s)]
                if not done:
                    break
            found.update(done)
        return sorted(found)

    def within(self, e: int, found: list[int]) -> list[int]:
        """Of elements those that lie in another."""
        return [x for x in found if e < x < self.ends[e]]

    def outermost(self, found: list[int]) -> list[int]:
        out: list[int] = []
        for e in found:
            if not out or e >= self.ends[out[-1]]:
                out.append(e)
        return out
