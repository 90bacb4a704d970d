"""Visible text of HTML pages with its layout (operator 7)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|[^>])*+)(>|\Z)|[^<]+|<",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
WHITE = re.compile(r"[ \t\n\r\f]+")
# Fixed sets of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
NOT_SHOWN = frozenset(
    "head script style title noscript template iframe noembed noframes object audio video canvas datalist annotation annotation-xml".split()
)
#: Of an svg what these hold is drawn as text, unless it lies in one of the others.
DRAWN = frozenset(["text", "foreignobject"])
DEFINITIONS = frozenset("defs symbol clippath mask pattern marker metadata desc".split())
#: Types of input that show no text of the page.
WORDLESS = frozenset("hidden password checkbox radio file color range".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure fieldset hr".split())
BLOCKS = PARAGRAPHS | frozenset(
    "html body div section article aside nav header footer main address form li dt dd figcaption details summary tr caption center legend".split()
)
#: Start tag -> open elements it ends, and the elements behind which it doesn't look.
ENDS: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "table", "td"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl", "table", "td"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl", "table", "td"])),
    "td": (frozenset(["td", "th"]), frozenset(["table"])),
    "th": (frozenset(["td", "th"]), frozenset(["table"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "tbody": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
    "thead": (frozenset(["thead", "tbody", "tfoot", "caption"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "select": (frozenset(["select"]), frozenset()),
    "input": (frozenset(["select"]), frozenset()),
    "textarea": (frozenset(["select"]), frozenset()),
    "body": (frozenset(["head"]), frozenset(["html"])),
}
FOREIGN = frozenset(["svg", "math"])
P_SCOPE = frozenset(["table", "td", "th", "caption", "button", "object"])
#: Padding may make a table so many times as large as its text; beyond that (one cell of a
#: megabyte over thousands of rows, or thousands of columns) columns are made narrower, the
#: widest first, and longer cells overflow.
PADDING = 32
#: Lists are indented, and tables inside tables aligned, down to this depth; cells of
#: deeper tables are blocks.  So no line is copied or indented more often than that.
LEVELS = 20


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def build_tree(html: str) -> Node:
    """Elements and text of a page, with tags implied where they are left out."""
    root = Node("html", {})
    stack = [root]
    where: dict[str, list[int]] = {}  # places of the open elements, so that none is walked past

    def top(tags: frozenset[str]) -> int:
        return max((where[t][-1] for t in tags if where.get(t)), default=0)

    def push(node: Node) -> None:
        where.setdefault(node.tag, []).append(len(stack))
        stack.append(node)

    def close(tags: frozenset[str], scope: frozenset[str]) -> None:
        k = top(tags)
        if k and k >= top(scope):
            for node in reversed(stack[k:]):
                where[node.tag].pop()
            del stack[k:]

    at, end = 0, len(html)
    while at < end:
        m = TOKEN.match(html, at)
        token = m.group()
        at = m.end()
        name = m.group(2)
        if name is None:
            if token[0] != "<" or token == "<":
                stack[-1].children.append(unescape(token))
            elif token.startswith("<![CDATA["):
                stack[-1].children.append(token[9:].removesuffix("]]>"))
            continue
        if not m.group(4):
            break  # a tag that never ends takes the rest, as in browsers
        tag = name.lower()
        if m.group(1):
            if tag in ("br", "p") and not where.get(tag):
                stack[-1].children.append(Node(tag, {}))  # as browsers do with a stray </p>, </br>
            scope = P_SCOPE if tag not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th") else frozenset(["table"]) - {tag}
            close(frozenset([tag]), scope - {tag})
            continue
        raw = m.group(3)
        attrs = {k.lower(): unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(raw)} if raw and raw != "/" else {}
        if tag == "html":
            root.attrs.update(attrs)
            continue
        if tag in BLOCKS:
            close(frozenset(["p"]), P_SCOPE)
        if tag in ENDS:
            close(*ENDS[tag])
            if tag == "tr":
                close(frozenset(["caption", "colgroup"]), frozenset(["table"]))
        if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            stack[-1].children.append(row := Node("tr", {}))
            push(row)
        node = Node(tag, attrs)
        stack[-1].children.append(node)
        if tag in RAW:
            stop = re.compile(f"</{re.escape(tag)}[\\s/>]", re.I).search(html, at)
            body = html[at : stop.start() if stop else end]
            node.children.append(unescape(body) if tag in ("textarea", "title") else body)
            at = html.find(">", stop.start()) + 1 or end if stop else end
        elif tag not in VOID and not (raw.endswith("/") and (tag in ("svg", "math") or top(FOREIGN) > top(DRAWN - {"text"}))):
            push(node)  # only in drawings and formulas does a slash end an element
    return root


class Writer:
    """Lays text out: collapses white space, keeps block spacing and list prefixes."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.gap = 0  # blank lines owed before the next text
        self.prefix: str | None = None
        self.indent = ""

    def put(self, text: str) -> None:
        if not self.line:
            self.lines += [""] * (self.gap if self.lines else 0)
            self.gap = 0
            self.line.append(self.indent if self.prefix is None else self.prefix)
            self.prefix, self.space = None, False
        if self.space:
            self.line.append(" ")
            self.space = False
        self.line.append(text)

    def flow(self, text: str) -> None:
        plain = WHITE.sub(" ", text)
        if plain.startswith(" "):
            self.space = bool(self.line)
            plain = plain[1:]
        tail = plain.endswith(" ")
        plain = plain[:-1] if tail else plain
        if plain:
            self.put(plain)
        self.space = self.space or (tail and bool(self.line))

    def box(self, text: str) -> None:
        """A field or button: its text stands apart from what is next to it."""
        self.space = bool(self.line)
        self.flow(text)
        self.space = bool(self.line)

    def preformatted(self, text: str) -> None:
        for k, line in enumerate(text.split("\n")):
            if k:
                self.end_line(keep_empty=True)
            if line:
                self.put(line)

    def end_line(self, keep_empty: bool = False) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip())
            self.line = []
        elif keep_empty and self.lines:
            self.gap += 1
        self.space = False

    def block(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def taken(self) -> list[str]:
        """The lines, without empty ones at either end."""
        self.end_line()
        first, last = 0, len(self.lines)
        while last and not self.lines[last - 1]:
            last -= 1
        while first < last and not self.lines[first]:
            first += 1
        return self.lines[first:last]

    def text(self) -> str:
        return "\n".join(self.taken())


def span_of(cell: Node, name: str, most: int) -> int:
    value = cell.attrs.get(name, "")
    return max(1, min(int(value), most)) if value.isascii() and value.isdigit() and len(value) < 7 else 1


def columns_of(rows: list[list[tuple[list[str], int, int]]]) -> list[dict[int, list[str]]]:
    """Each row's cells by their column.

    What cells above still hold is kept as ranges of columns, next to each other only
    where they end in different rows; a cell that would reach into one is cut short."""
    grid: list[dict[int, list[str]]] = []
    held: list[tuple[int, int, int]] = []  # first column, the one after the last, first row that is free
    for r, row in enumerate(rows):
        if any(until <= r for _, _, until in held):
            held = [h for h in held if h[2] > r]
        placed: dict[int, list[str]] = {}
        new: list[tuple[int, int, int]] = []
        column = at = 0
        for lines, columns, down in row:
            while at < len(held) and held[at][0] <= column:
                column = max(column, held[at][1])
                at += 1
            end = min(column + columns, held[at][0]) if at < len(held) else column + columns
            placed[column] = lines
            if down > 1:
                new.append((column, end, min(r + down, len(rows))))
            column = end
        if new:
            whole: list[tuple[int, int, int]] = []
            for h in sorted(held + new):
                if whole and whole[-1][1:] == (h[0], h[2]):
                    whole[-1] = (whole[-1][0], h[1], h[2])
                else:
                    whole.append(h)
            held = whole
        grid.append(placed)
    return grid


def align(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Lines of a table of ``(lines, colspan, rowspan)`` cells, columns two spaces apart."""
    grid = columns_of(rows)
    widths: dict[int, int] = {}
    for placed in grid:
        for c, lines in placed.items():
            widths[c] = max(widths.get(c, 0), *map(len, lines), 0)
    order = sorted(widths)
    lengths = sum(len(x) for placed in grid for lines in placed.values() for x in lines)
    height = sum(max((len(x) for x in placed.values()), default=0) for placed in grid)
    widest, gap = max(widths.values(), default=0), 2
    while height * sum(w + gap for w in widths.values()) > PADDING * (lengths + 1024) and gap:
        widest //= 2
        widths = {c: min(w, widest) for c, w in widths.items()}
        gap = 2 if widest else 0  # too many columns for any padding: the cells of a row just follow
    if len(order) == 1:
        return [x.rstrip() for placed in grid for lines in placed.values() for x in lines]
    starts, at = {}, 0
    for c in order:
        starts[c], at = at, at + widths[c] + gap
    out = []
    for placed in grid:
        for k in range(max((len(x) for x in placed.values()), default=0)):
            parts, at = [], 0  # a row's own cells only, whatever the columns of other rows
            for c, lines in placed.items():
                if k < len(lines) and lines[k]:
                    pad = " " * max(starts[c] - at, 2 if parts else 0)
                    parts += [pad, lines[k]]
                    at += len(pad) + len(lines[k])
            out.append("".join(parts).rstrip())
    return out


def hides(node: Node, visible: bool) -> tuple[bool, bool]:
    """(not laid out at all, text is visible) of an element, given its parent's."""
    attrs = node.attrs
    if node.tag in NOT_SHOWN or "hidden" in attrs:
        return True, False
    style = attrs.get("style")
    if style:
        rules = dict(
            (k.strip().lower(), v.split("!")[0].strip().lower())
            for k, _, v in (rule.partition(":") for rule in style.split(";"))
        )
        if rules.get("display") == "none":
            return True, False
        if "visibility" in rules:
            visible = rules["visibility"] not in ("hidden", "collapse")
    return False, visible


def drawn_text(svg: Node, visible: bool) -> list[tuple[Node, bool]]:
    """The elements of a drawing that hold text, and whether they are visible."""
    out: list[tuple[Node, bool]] = []
    work = [(child, visible) for child in reversed(svg.children)]
    while work:
        node, visible = work.pop()
        if isinstance(node, str) or node.tag in DEFINITIONS:
            continue
        gone, visible = hides(node, visible)
        if gone:
            continue
        if node.tag in DRAWN:
            out.append((node, visible))
        else:
            work += [(child, visible) for child in reversed(node.children)]
    return out


def field_text(field: Node) -> str:
    """What an input shows: its value, or else its placeholder."""
    kind = field.attrs.get("type", "").lower()
    if kind in WORDLESS:
        return ""
    if kind == "image":
        return field.attrs.get("alt", "")
    return field.attrs.get("value") or field.attrs.get("placeholder", "")


def text_of(node: Node) -> str:
    parts, work = [], [node]
    while work:
        x = work.pop()
        if isinstance(x, str):
            parts.append(x)
        else:
            work += reversed(x.children)
    return "".join(parts)


def shown_options(select: Node) -> tuple[bool, list[str]]:
    """(is a list box, labels that show): all options and group labels of a list box; of a
    drop-down the last option that is selected, or else the first that is not disabled."""
    box = "multiple" in select.attrs or span_of(select, "size", 1000) > 1
    shown: list[str] = []
    first = chosen = None
    work = [(child, False) for child in reversed(select.children)]
    while work:
        node, disabled = work.pop()
        if isinstance(node, str) or (box and hides(node, True)[0]):
            continue
        disabled = disabled or "disabled" in node.attrs
        if node.tag != "option":
            if node.tag == "optgroup":
                shown.append(node.attrs.get("label", ""))
            work += [(child, disabled) for child in reversed(node.children)]
            continue
        label = node.attrs.get("label") or text_of(node)
        shown.append(label)
        if "selected" in node.attrs:
            chosen = label
        if first is None and not disabled:
            first = label
    return box, shown if box else [x for x in (first if chosen is None else chosen,) if x]


def render(root: Node) -> str:
    """All visible text.  Walks with a stack of its own, so depth is no limit."""
    writers = [Writer()]
    lists: list[list] = []  # [ordered, next number]
    tables: list[list[list] | None] = []  # None: too deep to be aligned
    work: list[tuple] = [("enter", root, True, False)]
    while work:
        step, node, visible, pre = work.pop()
        w = writers[-1]
        if step == "leave":
            tag = node.tag
            if tag in ("ul", "ol"):
                lists.pop()
                w.indent = "  " * min(len(lists), LEVELS)
                w.block(0 if lists else 1)
            elif tag in ("td", "th") and tables and tables[-1] is not None:
                writers.pop()
                row = tables[-1][-1] if tables[-1] else tables[-1].append([]) or tables[-1][-1]
                row.append((w.taken(), span_of(node, "colspan", 1000), span_of(node, "rowspan", 65534)))
            elif tag in ("td", "th"):
                w.block(0)
            elif tag == "table":
                for line in align(tables.pop() or []):
                    w.put(line) if line else None
                    w.end_line()
                w.block(1)
            elif tag in BLOCKS:
                w.block(1 if tag in PARAGRAPHS else 0)
                w.prefix = None if tag == "li" else w.prefix
            continue
        if step == "line":
            w.block(0)
            continue
        if isinstance(node, str):
            if visible:
                w.preformatted(node) if pre else w.flow(node)
            continue
        gone, visible = hides(node, visible)
        if gone:
            continue
        tag = node.tag
        if tag == "br":
            w.end_line(keep_empty=True)
            continue
        if tag == "img":
            if visible and node.attrs.get("alt"):
                w.flow(node.attrs["alt"])
            continue
        if tag == "input":
            if visible:
                w.box(field_text(node))
            continue
        if tag == "select":
            if visible:
                listed, labels = shown_options(node)
                for label in labels:
                    w.block(0) if listed else None
                    w.box(label)
                w.block(0) if listed else None
            continue
        if tag == "svg":
            for child, seen in reversed(drawn_text(node, visible)):
                work += [("line", child, seen, pre), ("enter", child, seen, pre), ("line", child, seen, pre)]
            continue
        if tag in ("td", "th") and tables and tables[-1] is not None:
            writers.append(Writer())
        elif tag in ("td", "th"):
            w.block(0)
        elif tag == "tr" and tables and tables[-1] is not None:
            tables[-1].append([])
        elif tag in BLOCKS:
            w.block(1 if tag in PARAGRAPHS and not (tag in ("ul", "ol") and lists) else 0)
            if tag in ("ul", "ol"):
                start = node.attrs.get("start", "1")
                lists.append([tag == "ol", int(start) if start.isascii() and start.lstrip("-").isdigit() and len(start) < 10 else 1])
                w.indent = "  " * min(len(lists), LEVELS)
            elif tag == "li":
                depth = "  " * (min(len(lists), LEVELS) - 1)
                mark = "- "
                if lists and lists[-1][0]:
                    mark = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                w.prefix = depth + mark
            elif tag == "table":
                tables.append([] if len(tables) < LEVELS else None)
        work.append(("leave", node, visible, pre))
        inner = pre or tag in ("pre", "textarea")
        work += [("enter", child, visible, inner) for child in reversed(node.children)]
    return writers[0].text()


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``pages`` without the markup: ``page_id, text, n_chars``.

    Scripts, styles, the head, hidden elements (``hidden``, ``display: none``,
    ``visibility: hidden``) and comments are left out; navigation and the like stay,
    as they are visible.  A drop-down shows one option and a list box all, inputs show
    their value or placeholder, drawings their text elements, a line each.  Paragraph-like blocks are set apart by an empty line, other
    blocks by a line end; list items get ``- `` or their number; cells of a row are
    padded to their column.  Lists deeper than 20 are indented like the twentieth, and cells
    of tables inside 20 others are blocks.  Defined cases: null and empty pages give the empty text;
    unclosed and stray tags never fail; a null id and repeated rows are carried along;
    an empty table gives an empty result; further columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):  # bounds what is held of long pages
                part = batch.slice(start, 200)
                texts = [render(build_tree(h)) if h else "" for h in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "text", "n_chars"],
                )

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).alias("html")).mapInArrow(
        run, "page_id long, text string, n_chars long"
    )
