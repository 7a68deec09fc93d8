"""Visible text of HTML pages, laid out: a tree builder with implied tags, and a renderer.

Start tags close what they imply (a block closes an open p, an li an li, a cell a cell, and
so on); scripts, styles, templates, comments and the head show nothing, nor do elements that
are hidden by attribute, inline style or the page's style sheets, whose rules for types,
classes and ids count by their precedence (rules with combinators, pseudo-classes or
attributes are passed over, as are those for other media than the screen). What is visible
inside an invisible element shows. Elements are rendered as they close, from the innermost out,
so depth costs no stack. Blocks stand on lines of their own, paragraphs, headings, lists and
tables between empty lines; list items have bullets or numbers and indents; cells of a table
are padded to the width of their column, wide characters counting twice, and cells of several
rows keep their columns in the rows below; a closed list of options shows the chosen one;
preformatted text keeps its white space. Text outside any body element is visible text too.

Defined results: a null page stays null; an empty one gives the empty text; a tag that never
ends is text; pages of any length and depth are taken whole, in a time that grows with their
length; of rules of equal precedence (ties) the last counts; repeated pages are rendered
alike; columns of the input named like a result are replaced, all others kept; an empty table
stays empty.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_TAG = re.compile(
    r"<!--(?:[^-]|-(?!->))*-->|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-a-zA-Z0-9_:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACES = re.compile(r"[ \t\n\r\f]+")
_DECLARED = re.compile(r"(?:^|[;{\s])(display|visibility)\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I)
_SHEET = re.compile(r"<!--.*?-->|<script\b.*?</script\b|<style\b[^>]*>(.*?)(?:</style\b|\Z)", re.I | re.S)
_CSS_COMMENT = re.compile(r"/\*.*?\*/", re.S)
_COMPOUND = re.compile(r"(?:\*|[a-z][a-z0-9-]*)?(?:[.#][a-z_-][a-z0-9_-]*)*", re.I)

# Fixed lists of element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template title noscript iframe noembed noframes object audio video canvas desc defs metadata datalist".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure fieldset article section nav aside header footer main form address details menu".split())
BLOCK = SPACED | frozenset("html body div li dt dd tr td th thead tbody tfoot caption figcaption legend summary hr center dialog search hgroup".split())
IN_HEAD = frozenset("head title meta link style script base template noscript".split())
#: What a start tag closes, up to the elements that hold it.
CLOSES = {
    "li": ({"li", "p"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd", "p"}, {"dl"}),
    "dd": ({"dt", "dd", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "p"}, {"table"}),
    "td": ({"td", "th", "p"}, {"table", "tr"}),
    "th": ({"td", "th", "p"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "p"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "p"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "p"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
#: Elements that an end tag of something outside doesn't cross.
SCOPES = frozenset({"table", "td", "th", "caption", "html", "body"})
#: Columns and rows that a cell may span (the standard's limits).
MOST_COLUMNS, MOST_ROWS = 1000, 65534
#: Kinds of input that show their value.
SHOWN_INPUTS = frozenset("text search email url tel number date time week month datetime-local submit button reset".split())


class _Element:
    __slots__ = ("name", "gone", "unseen", "pre", "items", "rows", "number", "span", "down")

    def __init__(self, name: str, gone: bool, unseen: bool, pre: bool):
        self.name, self.gone, self.unseen, self.pre = name, gone, unseen, pre
        self.items: list = []  # strings of inline text, or (spaced, lines) of blocks
        self.rows: list = []
        self.number, self.span, self.down = 1, 1, 1


class _Sheet:
    """The rules of a page that show or hide, by the last thing that their selector asks for."""

    def __init__(self, page: str):
        self.rules: dict[str, list] = {}
        self.count = 0
        if "<style" not in page.lower():
            return
        for m in _SHEET.finditer(page):
            if m[1]:
                self._read(_CSS_COMMENT.sub(" ", m[1]))

    def _read(self, text: str) -> None:
        """Rules in order; blocks for the screen count as if they stood alone, other at-rules don't."""
        at, n = 0, len(text)
        while at < n:
            brace = text.find("{", at)
            if brace < 0:
                return
            head = text[at:brace].rpartition(";")[2].strip(" \t\r\n\f}")
            if head.startswith("@"):
                wanted = re.match(r"@media\s+(?:only\s+)?(?:screen|all)\b", head, re.I) or re.match(r"@(?:supports|layer)\b", head, re.I)
                at = brace + 1 if wanted else _closing(text, brace)
                continue
            end = text.find("}", brace)
            end = n if end < 0 else end
            self._rule(head, text[brace + 1 : end])
            at = end + 1

    def _rule(self, selectors: str, body: str) -> None:
        told = [(m[1].lower(), m[2].lower(), bool(m[3])) for m in _DECLARED.finditer(body)]
        if not told:
            return
        for one in selectors.split(","):
            one = one.strip()
            if not one or not _COMPOUND.fullmatch(one):
                continue
            parts = re.findall(r"[.#]?[^.#]+", one)
            ids = [x[1:] for x in parts if x[0] == "#"]
            classes = [x[1:] for x in parts if x[0] == "."]
            tag = parts[0].lower() if parts[0][0] not in ".#*" else ""
            key = f"#{ids[0]}" if ids else f".{classes[0]}" if classes else tag or "*"
            rank = (len(ids), len(classes), bool(tag))
            self.count += 1
            self.rules.setdefault(key, []).append((tag, classes, ids, rank, self.count, told))

    def of(self, name: str, given: dict[str, str]) -> dict[str, str]:
        """What holds of display and visibility for an element, by sheet and its own style."""
        best: dict[str, tuple] = {}
        if self.rules:
            own = given.get("class", "").split()
            for key in (name, "*", *(f".{c}" for c in dict.fromkeys(own)), f"#{given.get('id', '')}"):
                for tag, classes, ids, rank, order, told in self.rules.get(key, ()):
                    if (not tag or tag == name) and all(c in own for c in classes) and all(i == given.get("id") for i in ids):
                        for what, value, important in told:
                            best[what] = max(best.get(what, ((False,),)), ((important, *rank), order, value))
        if "style" in given:
            for m in _DECLARED.finditer(given["style"]):
                found = ((bool(m[3]), 1 << 30, 0, 0), 0, m[2].lower())
                if found[0] >= best.get(m[1].lower(), (found[0],))[0]:
                    best[m[1].lower()] = found
        return {what: found[2] for what, found in best.items()}


def _closing(text: str, brace: int) -> int:
    """The place after the block that starts at brace."""
    depth = 0
    for m in re.compile(r"[{}]").finditer(text, brace):
        depth += 1 if m[0] == "{" else -1
        if not depth:
            return m.end()
    return len(text)


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        out.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return out


def _number(text: str, default: int) -> int:
    m = re.match(r"\s*([0-9]{1,9})", text)
    return int(m[1]) if m else default


def _inline(parts: list[str], lines: list[str]) -> None:
    """Inline parts as lines; text marked with \\x00 is preformatted, \\x01 is a line break."""
    text = "".join(parts)
    if "\x00" not in text:
        for line in text.split("\x01"):
            lines.append(_SPACES.sub(" ", line).strip(" "))
    else:
        out = [""]
        for k, piece in enumerate(text.split("\x00")):
            if k % 2:
                first, *rest = re.split(r"\r\n?|\n|\x01", piece)
                out[-1] += first
                out += rest
            else:
                first, *rest = _SPACES.sub(" ", piece).split("\x01")
                out[-1] += first
                out += rest
        lines += [x.rstrip(" ") for x in out]


def _lines(items: list) -> list[str]:
    """The lines of mixed inline text and blocks."""
    if len(items) == 1 and not isinstance(items[0], str):
        return items[0][1]
    out: list[str] = []
    parts: list[str] = []
    gap = False

    def flush():
        nonlocal gap
        if parts:
            own: list[str] = []
            _inline(parts, own)
            parts.clear()
            while own and not own[-1]:
                own.pop()
            while own and not own[0]:
                own.pop(0)
            if own:
                if gap and out:
                    out.append("")
                gap = False
                out.extend(own)

    for item in items:
        if isinstance(item, str):
            parts.append(item)
            continue
        flush()
        spaced, lines = item
        if lines:
            if out and (spaced or gap):
                out.append("")
            out.extend(lines)
            gap = spaced
    flush()
    return out


def _wide(text: str) -> int:
    """Columns that a text takes on a page of equal letters."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def _table(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Rows of cells (lines, columns, rows spanned), each column as wide as its widest unspanned cell."""
    width: dict[int, int] = {}
    taken: dict[int, int] = {}  # columns and the row below the cell that reaches down into them
    placed = []
    for y, row in enumerate(rows):
        at, own = 0, []
        for lines, span, down in row:
            while taken.get(at, 0) > y:
                at += 1
            if span == 1 and lines:
                width[at] = max(width.get(at, 0), max(map(_wide, lines)))
            own.append((at, lines))
            if down != 1:
                taken.update((at + j, y + down if down else len(rows)) for j in range(span))
            at += span
        placed.append(own)
    edges = sorted(width)
    starts = [0]
    for c in edges:
        starts.append(starts[-1] + width[c])
    out = []
    for own in placed:
        for k in range(max((len(lines) for _, lines in own), default=0)):
            text = ""
            for at, lines in own:
                if k < len(lines) and lines[k]:
                    due = starts[bisect_right(edges, at - 1)] + 2 * at
                    text += " " * max(due - _wide(text), 0) + lines[k]
            out.append(text.rstrip(" "))
    return out


class _Builder:
    def __init__(self, sheet: _Sheet):
        self.sheet = sheet
        self.open = [_Element("html", False, False, False)]
        self.places: dict[str, list[int]] = {}  # of open elements by name, the innermost last

    def start(self, name: str, rest: str) -> bool:
        """Open an element; whether it stays open."""
        if name in ("html", "body"):
            while len(self.open) > 1 and self.open[-1].name in IN_HEAD:
                self.close()
            self._shown(self.open[0], name, _attributes(rest) if rest else {})
            return False
        if name not in IN_HEAD and self.open[-1].name == "head":
            self.close()
        if name in CLOSES:
            closes, until = CLOSES[name]
            self.close_implied(closes, until)
        elif name in BLOCK:
            self.close_implied({"p"}, SCOPES | {"li", "dd", "dt", "div", "section", "article", "blockquote"})
        top = self.open[-1]
        if name in ("td", "th") and top.name != "tr":
            self.start("tr", "")
            top = self.open[-1]
        given = _attributes(rest) if rest else {}
        element = _Element(name, top.gone, top.unseen, top.pre or name in ("pre", "textarea", "xmp"))
        if name == "br":
            top.items.append("\x01")
            return False
        self._shown(element, name, given)
        if name in VOID:
            if name == "hr":
                top.items.append((False, []))
            elif not element.gone and not element.unseen:
                if name == "img" and given.get("alt"):
                    top.items.append(given["alt"])
                elif name == "input" and given.get("type", "text").lower() in SHOWN_INPUTS and given.get("value"):
                    top.items.append(given["value"])
            return False
        if name == "ol":
            element.number = _number(given.get("start", ""), 1)
        if name == "li" and "value" in given and top.name == "ol":
            top.number = _number(given["value"], top.number)
        if name in ("td", "th"):
            element.span = min(max(_number(given.get("colspan", ""), 1), 1), MOST_COLUMNS)
            element.down = min(_number(given.get("rowspan", ""), 1), MOST_ROWS)
        if name == "option":
            element.number = 2 if "selected" in given else 1
        if name == "select":
            element.number = 0 if "multiple" in given or _number(given.get("size", ""), 1) > 1 else 1
        self.places.setdefault(name, []).append(len(self.open))
        self.open.append(element)
        return True

    def _shown(self, element: _Element, name: str, given: dict[str, str]) -> None:
        told = self.sheet.of(name, given) if given or self.sheet.rules else {}
        if name in HIDDEN or ("display" in told and told["display"] == "none") or ("display" not in told and "hidden" in given):
            element.gone = True
        if "visibility" in told and told["visibility"] not in ("inherit", "unset"):
            element.unseen = told["visibility"] in ("hidden", "collapse")

    def last(self, names) -> int:
        """The place of the innermost open element of one of names; 0 if there is none."""
        return max((self.places[x][-1] for x in names if self.places.get(x)), default=0)

    def close_implied(self, names, until) -> None:
        """Close the outermost of names that lies inside all of until, and what is in it."""
        bound, found = self.last(until), len(self.open)
        for x in names:
            own = self.places.get(x)
            if own and own[-1] > bound:
                found = min(found, own[bisect_right(own, bound)])
        while len(self.open) > found:
            self.close()

    def end(self, name: str) -> None:
        at = self.last((name,))
        if name == "p" and not at:
            self.open[-1].items.append((True, []))
            return
        crosses = name in SCOPES or name in ("tr", "tbody", "thead", "tfoot")
        if at and (crosses or at >= self.last(SCOPES)):
            while len(self.open) > at:
                self.close()

    def text(self, text: str) -> None:
        top = self.open[-1]
        if top.gone:
            if top.name == "head" and text.strip():
                self.close()
                self.text(text)
            return
        if top.unseen:
            return
        text = html.unescape(text) if "&" in text else text
        text = text.replace("\x00", "").replace("\x01", "")
        top.items.append(f"\x00{text}\x00" if top.pre else text)

    def close(self) -> None:
        e = self.open.pop()
        self.places[e.name].pop()
        parent = self.open[-1]
        if e.gone:
            return
        if e.name == "option" and self.places.get("select"):
            select = self.open[self.places["select"][-1]]
            select.rows.append((e.number, " ".join(x for x in _lines(e.items) if x)))
            return
        if e.name == "select":
            shown = [text for _, text in e.rows]
            chosen = [text for k, text in e.rows if k == 2]
            if e.number:
                parent.items += chosen[-1:] or shown[:1]
            else:  # an open list
                parent.items.append((False, shown))
            return
        if e.name not in BLOCK:
            parent.items += e.items
            parent.rows += e.rows
            return
        if e.name in ("td", "th"):
            parent.rows.append((_lines(e.items), e.span, e.down))
            return
        if e.name == "tr":
            if e.rows or e.items:
                loose = _lines(e.items)
                parent.rows.append(e.rows + ([(loose, 1, 1)] if loose else []))
            return
        if e.name in ("thead", "tbody", "tfoot"):
            parent.rows += e.rows
            parent.items += e.items
            return
        if e.name == "table" or e.rows:
            rows = [r for r in e.rows if isinstance(r, list)]
            loose = [r for r in e.rows if not isinstance(r, list)]
            lines = _lines(e.items)
            lines = lines + _table(rows + [[c] for c in loose])
            parent.items.append((True, lines))
            return
        lines = _lines(e.items)
        if e.name == "li":
            mark = "- "
            if parent.name == "ol":
                mark = f"{parent.number}. "
                parent.number += 1
            if lines:
                lines = [mark + lines[0], *((" " * len(mark) + x if x else "") for x in lines[1:])]
        elif e.name == "dd":
            lines = ["  " + x if x else "" for x in lines]
        elif e.name == "blockquote":
            lines = ["> " + x if x else ">" for x in lines]
        spaced = e.name in SPACED
        if e.name in ("ul", "ol", "menu") and self.last(("li",)) > self.last(SCOPES):
            spaced = False
        parent.items.append((spaced, lines))


def visible_text(page: str) -> str:
    """The visible text of a page, laid out."""
    b, at = _Builder(_Sheet(page)), 0
    n, last = len(page), page.rfind(">")
    while at < n:
        lt = page.find("<", at)
        if lt < 0 or lt > last:  # no tag can end any more
            hidden = page.find("<!--", at)
            b.text(page[at:] if hidden < 0 else page[at:hidden])
            break
        m = _TAG.match(page, lt)
        if not m:
            if page.startswith("<!--", lt):  # a comment that never ends hides the rest
                b.text(page[at:lt])
                break
            b.text(page[at : lt + 1])
            at = lt + 1
            continue
        if lt > at:
            b.text(page[at:lt])
        at = m.end()
        name = m[2].lower() if m[2] else ""
        if not name:
            continue
        if m[1]:
            b.end(name)
        elif b.start(name, m[3]) and name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
            b.text(page[at : close.start() if close else n])
            b.end(name)
            at = close.end() if close else n
    while len(b.open) > 1:
        b.close()
    root = b.open[0]
    if root.gone:
        return ""
    rows = [r if isinstance(r, list) else [r] for r in root.rows]
    return "\n".join(_lines(root.items + ([(True, _table(rows))] if rows else [])))


def _renderer():
    @F.arrow_udf("string")
    def render(pages: pa.Array) -> pa.Array:
        return pa.array([visible_text(p.as_py()) if p.is_valid else None for p in pages], pa.string())

    return render


def extracted(pages: DataFrame) -> DataFrame:
    """pages with text, the visible text of html."""
    return pages.withColumn("text", _renderer()(F.col("html")))
