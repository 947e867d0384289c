"""Layout-aware text of web pages: a tree of elements, then its visible text with the spacing that a page shows.

The tree builder closes elements that HTML lets stand open (paragraphs, list items, table cells and rows, options),
ignores end tags without a start, and takes scripts, styles and the like as raw text. Not visible are the head,
scripts, styles, templates, elements with ``hidden`` or ``display:none``, the own text of elements with
``visibility:hidden`` (what within them is ``visible`` shows), closed dialogs and hidden inputs. Blocks stand on lines of
their own, paragraphs and headings with a blank line around, list items behind a bullet or number with indents for lists
in lists. Table cells are laid out as pages are, lists, preformatted text and tables within them too, and set side by
side in columns of one width each, with regard to ``colspan`` and ``rowspan``; text wider than ``WIDEST_COLUMN`` goes on
in the cell's next line, and a word or a finished line that is wider runs over. What stands in a table or row outside its cells
has a row or cell of its own; cells and rows are also found within forms and the like.

Elements may be nested to any depth: nothing here is recursive, and tables are laid out from the innermost on.

Defined cases: null and empty pages give the empty text; text without markup is one paragraph; unclosed comments and
tags are dropped to the page's end, as browsers do; repeated rows are all returned; other columns pass through, an
existing output column is replaced; an empty table gives no rows. A page of any length is taken whole.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .piece_bpe import with_column, with_field

#: Characters of a table's column, from which text is wrapped.
WIDEST_COLUMN = 120
# Fixed values of HTML: the most columns and rows that a cell can span.
MOST_COLUMNS, MOST_ROWS = 1000, 65534
# Fixed values of HTML: element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript title iframe noembed noframes object audio video canvas datalist meta link base param source track".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figure dl ul ol table fieldset".split())
BLOCK = SPACED | frozenset("html body div section article nav aside header footer main address form li dt dd hr tr caption thead tbody tfoot figcaption details summary legend menu hgroup search center dir option optgroup select".split())
CLOSES_P = BLOCK - frozenset("html body tr caption thead tbody tfoot option optgroup select legend summary".split())
#: What is never shown within drawings and formulas.
UNSEEN_WITHIN = {"svg": frozenset("defs desc metadata symbol clippath mask pattern marker filter lineargradient radialgradient".split()), "math": frozenset(["annotation", "annotation-xml"])}
#: A start tag of the first kind ends an open element of the second, unless one of the third stands between.
IMPLIED_END = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])), "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th", "caption"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])), "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "thead": (frozenset(["thead", "tbody", "tfoot", "tr", "td", "th", "caption"]), frozenset(["table"])),
    "tbody": (frozenset(["thead", "tbody", "tfoot", "tr", "td", "th", "caption"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody", "tfoot", "tr", "td", "th", "caption"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist", "optgroup"])), "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "body": (frozenset(["head"]), frozenset()),
}
#: What ends a search outwards for an element to close: cells and the like hold their own content.
SCOPE = frozenset("table td th caption html template button object".split())
HEAD_ONLY = frozenset("html head meta link base title script style noscript template".split())
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_UNSEEN_STYLE = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible|initial)", re.I)
_SPACES = re.compile(r"[ \t\n\r\f\xa0]+")


class Element:
    __slots__ = ("tag", "attributes", "children", "parent", "veiled")

    def __init__(self, tag: str, attributes: str = "", parent: Element | None = None):
        self.tag, self.attributes, self.children, self.parent = tag, attributes, [], parent
        #: Whether its own text isn't seen, by the nearest ``visibility`` around it.
        self.veiled = parent is not None and parent.veiled
        if "visibility" in attributes.lower() and (told := _VISIBILITY.findall(self.get("style") or "")):
            self.veiled = told[-1].lower() in ("hidden", "collapse")

    def get(self, name: str) -> str | None:
        if name not in self.attributes.lower():
            return None
        for key, value in _ATTRIBUTE.findall(self.attributes):
            if key.lower() == name:
                return html.unescape(value.strip("\"'"))
        return None

    def number(self, name: str, most: int) -> int:
        """A count of at least one."""
        value = self.get(name) or "1"
        return max(1, min(most, int(value[:9]))) if value.isdecimal() and value.isascii() else 1


class Stack(list):
    """The open elements; how many there are of each kind, so that a search for one that isn't open costs nothing."""

    def __init__(self, root: Element):
        super().__init__([root])
        self.open: dict[str, int] = {}

    def push(self, element: Element) -> None:
        self.append(element)
        self.open[element.tag] = self.open.get(element.tag, 0) + 1

    def cut(self, place: int) -> None:
        """Close the elements from a place on."""
        for element in self[place:]:
            self.open[element.tag] -= 1
        del self[place:]

    def close_to(self, kinds, stops) -> None:
        """Close the outermost open element of the kinds, as far as none of the stops stands before it."""
        left, found = sum(self.open.get(kind, 0) for kind in kinds), None
        for k in range(len(self) - 1, 0, -1):
            if not left:
                break
            if self[k].tag in kinds:
                found, left = k, left - 1
            elif self[k].tag in stops:
                break
        if found:
            self.cut(found)


def build_tree(page: str) -> Element:
    """The elements of a page."""
    root = Element("html")
    stack, at, end = Stack(root), 0, len(page)

    def within(kind: str) -> bool:
        return bool(stack.open.get(kind))

    while at < end:
        match = _TAG.search(page, at)
        text = page[at : match.start() if match else end]
        if text:
            if stack[-1].tag == "head" and text.strip():
                stack.cut(len(stack) - 1)
            if not stack[-1].veiled:
                stack[-1].children.append(html.unescape(text) if "&" in text else text)
        if not match:
            break
        at = match.end()
        closing, tag, attributes = (match.group(1), match.group(2), match.group(3)) if match.group(2) else (match.group(4), match.group(5), match.group(6))
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if tag == "br" or tag == "p" and not within("p"):
                stack[-1].children.append(Element(tag, "", stack[-1]))
                continue
            for k in range(len(stack) - 1, 0, -1) if within(tag) else ():
                if stack[k].tag == tag:
                    if tag == "text" and within("svg"):
                        stack[k].children.append(" ")
                    stack.cut(k)
                    break
                if stack[k].tag in SCOPE and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html", "td", "th", "caption"):
                    break
            continue
        if tag == "html":
            root.attributes = root.attributes or attributes
            continue
        if stack[-1].tag == "head" and tag not in HEAD_ONLY:
            stack.cut(len(stack) - 1)
        if tag in IMPLIED_END:
            stack.close_to(*IMPLIED_END[tag])
        if tag in CLOSES_P:
            stack.close_to(("p",), SCOPE)
        element = Element(tag, attributes, stack[-1])
        if any(tag in own and within(kind) for kind, own in UNSEEN_WITHIN.items()):
            element.attributes = "hidden"
        if tag == "text" and within("svg"):  # texts of a drawing stand apart
            stack[-1].children.append(" ")
        stack[-1].children.append(element)
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            body = page[at : close.start() if close else end]
            if not element.veiled:
                element.children.append(html.unescape(body) if tag in ("textarea", "title") else body)
            at = close.end() if close else end
            continue
        stack.push(element)
    return root


def visible(element: Element) -> bool:
    if element.tag in UNSEEN:
        return False
    if not element.attributes:
        return True
    if element.tag == "dialog" and element.get("open") is None or element.tag == "input" and (element.get("type") or "").lower() == "hidden":
        return False
    return element.get("hidden") is None and not _UNSEEN_STYLE.search(element.get("style") or "")


class Lines:
    """Text being laid out: finished lines, the line being filled, and the blank lines that are due."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.due = 0  # 1: a new line, 2: a blank line besides
        self.space = False
        self.indents: list[str] = []
        self.mark = ""
        self.finished: set[int] = set()  # lines that aren't to be wrapped

    def words(self, text: str) -> None:
        flat = _SPACES.sub(" ", text)
        if flat == " " or not flat:
            self.space = self.space or bool(flat)
            return
        self.start()
        if (self.space or flat[0] == " ") and self.line:
            self.line.append(" ")
        self.line.append(flat.strip(" "))
        self.space = flat[-1] == " "

    def start(self) -> None:
        """Begin a line, if a break is due."""
        if self.due:
            self.flush()
            if self.due > 1 and self.lines and self.lines[-1]:
                self.lines.append("")
            self.due = 0

    def flush(self) -> None:
        if self.line:
            self.lines.append("".join(self.indents) + self.mark + "".join(self.line))
            self.mark = " " * len(self.mark)
        self.line, self.space = [], False

    def block(self, spaced: bool) -> None:
        self.due = max(self.due, 2 if spaced else 1)

    def whole(self, line: str) -> None:
        """A line as it is."""
        self.start()
        self.flush()
        self.finished.add(len(self.lines))
        self.lines.append("".join(self.indents) + self.mark + line.rstrip() if line.strip() else "")
        self.mark = " " * len(self.mark)

    def end(self) -> list[str]:
        self.flush()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines

    def wrapped(self) -> list[str]:
        """The lines, those wider than a column cut at spaces."""
        out = []
        for k, line in enumerate(self.end()):
            if len(line) <= WIDEST_COLUMN or k in self.finished:
                out.append(line)
                continue
            indent = line[: len(line) - len(line.lstrip(" "))]
            part = indent
            for word in line.split():
                if len(part) > len(indent) and len(part) + 1 + len(word) > WIDEST_COLUMN:
                    out.append(part)
                    part = indent
                part += word if len(part) == len(indent) else " " + word
            out.append(part)
        return out


def shown_value(element: Element) -> str | None:
    """What an input shows."""
    if element.tag == "input" and not element.veiled and (value := element.get("value")) and (element.get("type") or "text").lower() in ("text", "submit", "button", "reset", "search", "email", "url", "tel"):
        return value
    return None


_CELLS = frozenset(["td", "th"])
_ROWS = frozenset(["tr", "caption", "thead", "tbody", "tfoot", "td", "th"])


class Table:
    """One table: its rows of cells, each cell with its lines and spans."""

    def __init__(self, element: Element, laid: dict[int, list[str]]):
        self.element, self.laid = element, laid
        # Elements with rows or cells somewhere within, but for tables within.
        self.holders: dict[frozenset, set[int]] = {_ROWS: set(), _CELLS: set()}
        todo = list(element.children)
        while todo:
            node = todo.pop()
            if isinstance(node, str) or node.tag in UNSEEN or node.tag == "table":
                continue
            todo += node.children
            for kinds, found in self.holders.items():
                up = node.parent if node.tag in kinds else None
                while up is not None and up is not element and id(up) not in found:
                    found.add(id(up))
                    up = up.parent

    def parted(self, element: Element, kinds: frozenset) -> Iterator[tuple[Element | None, Lines]]:
        """The visible parts of a table, section or row in order: elements of the kinds, also those within others, and
        the text of what stands between them."""
        todo, between = [None, *reversed(element.children)], []
        while todo:
            node = todo.pop()
            cell = node is not None and not isinstance(node, str) and node.tag in kinds and visible(node)
            holder = node is not None and not isinstance(node, str) and not cell and node.tag != "table" and visible(node) and id(node) in self.holders[kinds]
            if node is None or cell or holder:
                if between and (lines := lay_out(between, self.laid)).end():
                    yield None, lines
                between = []
                if cell:
                    yield node, Lines()
                elif holder:
                    todo += [None, *reversed(node.children)]
            else:
                between.append(node)

    def rows(self) -> list[list[tuple[list[str], int, int]]]:
        """Rows of ``(lines, columns, rows)``; what isn't in a cell spans all columns."""
        out, todo = [], [iter(self.parted(self.element, _ROWS))]
        while todo:
            node, lines = next(todo[-1], (None, None))
            if lines is None:
                todo.pop()
            elif node is None:
                out.append([(lines.wrapped(), MOST_COLUMNS, 1)])
            elif node.tag == "tr":
                cells = []
                for cell, own in self.parted(node, _CELLS):
                    cells.append((own.wrapped(), 1, 1) if cell is None else (lay_out(cell.children, self.laid).wrapped(), cell.number("colspan", MOST_COLUMNS), cell.number("rowspan", MOST_ROWS)))
                out.append(cells)
            elif node.tag in ("thead", "tbody", "tfoot"):
                todo.append(iter(self.parted(node, _ROWS)))
            else:  # a caption, or a cell without a row
                out.append([(lay_out(node.children, self.laid).wrapped(), MOST_COLUMNS, 1)])
        return out

    def lines(self) -> list[str]:
        placed, taken, widths = [], {}, {}
        for row in self.rows():
            at, cells = 0, []
            for lines, columns, rows in row:
                while taken.get(at):  # a cell of a row above
                    at += 1
                cells.append((at, columns, lines))
                if columns < MOST_COLUMNS and rows > 1:
                    taken.update((k, max(taken.get(k, 0), rows)) for k in range(at, at + columns))
                if columns == 1 and lines:
                    widths[at] = max(widths.get(at, 0), *(min(len(x), WIDEST_COLUMN) for x in lines))
                elif columns == 1:
                    widths.setdefault(at, 0)
                at += columns
            placed.append(cells)
            taken = {k: n - 1 for k, n in taken.items() if n > 1}
        columns = sorted(widths)
        starts = dict(zip(columns, np.cumsum([0, *(widths[k] + 2 for k in columns)]).tolist(), strict=False))
        place = lambda at: starts[columns[k]] if (k := bisect.bisect_left(columns, at)) < len(columns) else (starts[columns[-1]] + widths[columns[-1]] + 2 if columns else 0)
        out = []
        for cells in placed:
            for n in range(max((len(lines) for _, _, lines in cells), default=0)):
                line = ""
                for at, _, lines in cells:
                    if n < len(lines) and lines[n]:
                        line = (line.ljust(max(place(at), len(line) + 2)) if at else line) + lines[n]
                out.append(line)
        return out


def render(page: str | None) -> str:
    """The visible text of a page."""
    if not page:
        return ""
    root = build_tree(page)
    tables, todo = [], [root]
    while todo:
        node = todo.pop()
        if not isinstance(node, str):
            if node.tag == "table":
                tables.append(node)
            todo += reversed(node.children)
    laid: dict[int, list[str]] = {}
    for table in reversed(tables):  # those within others first
        laid[id(table)] = Table(table, laid).lines() if visible(table) else []
    return "\n".join(lay_out([root], laid).end())


def lay_out(nodes: list, laid: dict[int, list[str]]) -> Lines:
    """The lines of elements and strings that stand one after the other; ``laid`` has those of the tables in them."""
    out = Lines()
    # A frame to enter is (element, None); one to leave is (element, what to restore).
    todo: list = [(node, None, None) for node in reversed(nodes)]
    numbers: list[int | None] = []
    pre = 0
    while todo:
        node, leave, parent = todo.pop()
        if isinstance(node, str):
            if pre:
                first, *more = node.replace("\r\n", "\n").split("\n")
                out.start()
                out.line.append(first)
                for line in more:
                    out.line or out.whole("")
                    out.flush()
                    out.line = [line] if line else []
            else:
                out.words(node)
            continue
        tag = node.tag
        if leave is not None:
            pre -= tag == "pre"
            if tag == "pre":
                out.flush()
            if leave:
                out.start() if out.line else None
                out.flush()
                out.indents, out.mark = leave
            if tag in ("ul", "ol", "menu", "dir"):
                numbers.pop()
            out.block(tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and numbers))
            continue
        if not visible(node):
            continue
        if tag == "br":
            if out.due or not out.line:
                out.start()
                if out.lines and out.lines[-1] and not out.line:
                    out.lines.append("")
            out.flush()
            continue
        if tag == "hr":
            out.block(False)
            if not node.veiled:
                out.whole("---")
            out.block(False)
            continue
        if tag == "table":
            out.block(True)
            for line in laid.pop(id(node)):
                out.whole(line)
            out.block(True)
            continue
        if tag in ("td", "th"):
            out.words(" ")
        if value := shown_value(node):
            out.words(value)
            continue
        if tag in BLOCK:
            nested = tag in ("ul", "ol", "menu", "dir") and numbers
            out.block(tag in SPACED and not nested)
            restore: object = ()
            if tag in ("ul", "ol", "menu", "dir"):
                start = node.get("start") or "1"
                numbers.append((int(start) if start.lstrip("-").isdecimal() else 1) if tag == "ol" else None)
            elif tag == "li":
                out.start()
                out.flush()
                restore = (list(out.indents), out.mark)
                bullet = "- "
                if numbers and numbers[-1] is not None:
                    bullet, numbers[-1] = f"{numbers[-1]}. ", numbers[-1] + 1
                out.indents, out.mark = [*out.indents, " " * len(out.mark)], " " * len(bullet) if node.veiled else bullet
            elif tag in ("blockquote", "dd"):
                out.start()
                out.flush()
                restore = (list(out.indents), out.mark)
                out.indents, out.mark = [*out.indents, " " * len(out.mark), "  "], ""
            pre += tag == "pre"
            todo.append((node, restore, None))
        todo += [(c, None, node) for c in reversed(node.children)]
    return out


def extract(pages: DataFrame, html_col: str = "html", out_col: str = "text", keep_html: bool = True) -> DataFrame:
    """Add ``out_col``: the visible text of each page."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([render(p) for p in batch.column(html_col).to_pylist()], pa.string())
            yield with_column(batch if keep_html else batch.drop_columns([html_col]), out_col, texts)

    source = pages.drop(out_col)
    schema = source.schema if keep_html else T.StructType([f for f in source.schema.fields if f.name != html_col])
    return source.mapInArrow(run, with_field(schema, out_col, T.StringType()))
