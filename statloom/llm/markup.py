"""Markup residue in documents: clean text that keeps headings, list items, code blocks and formulas.

A body may mix HTML, Markdown, wiki and LaTeX. It is parsed into leaf nodes, each with its root-to-leaf tag path (with
the classes its tags state; the other dialects' blocks get paths of their own, as if they were tags). By tag path the
length of the nodes' own text (that of links is not the page's own) and its punctuation are aggregated, the two ratios
are fused and smoothed over the node sequence, and paths below a threshold of the document are no content: menus, link
lists and footers, in whatever tags they stand. A heading is short by nature and stands or falls with its section.
Each document is handled where it lies: nothing is shuffled.
"""

from __future__ import annotations

import html
import math
import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ELEMENTS = ("heading", "list_item", "code_block", "formula")

#: HTML elements, as blocks that break the text, as inline marks, and as parts that are never shown.
BLOCK_TAGS = "html body div p ul ol li dl dt dd table thead tbody tfoot tr td th caption h1 h2 h3 h4 h5 h6 blockquote section article header footer nav aside main figure figcaption hr pre form address details summary center"
INLINE_TAGS = "a b i u s em strong span sub sup br code kbd samp var small big font img abbr acronym cite q del ins strike tt mark label time wbr ref nowiki references gallery input button"
HIDDEN_TAGS = "head style script title meta link noscript template"
_KNOWN = frozenset((BLOCK_TAGS + " " + INLINE_TAGS + " " + HIDDEN_TAGS).split())
_BLOCK = frozenset(BLOCK_TAGS.split())

_ATTRS = r"(?:\s(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)?"
_TAG = re.compile(rf"<(/?)([A-Za-z][A-Za-z0-9]*)({_ATTRS})/?>")
_CODE = re.compile(r"```|~~~|\\begin\{(verbatim|lstlisting|minted|Verbatim|alltt)\*?\}|<(pre|syntaxhighlight|source)\b" + _ATTRS + ">", re.I)
_ESCAPED = re.compile(r"&(?:amp;)*lt;/?(?:h[1-6]|p|div|ul|ol|li|pre|code|table|tr|td|b|i|em|strong|span|a|br|math|sup|sub|html|body|head|syntaxhighlight|ref)\b[^\n]*?&(?:amp;)*gt;", re.I)
_ENTITY = re.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|nbsp|lt|gt|amp|quot|apos|ndash|mdash|hellip|le|ge|times|plusmn|micro|deg|alpha|beta|eta|chi|mu|[A-Za-z]{2,8}[0-9]{0,2});")
_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(head|style|script|title|noscript|template)\b" + _ATTRS + r">.*?(?:</\1\s*>|\Z)", re.I | re.S)
_MATH = re.compile(
    r"\$\$(?!\s*\$).+?\$\$|\$(?![\s$])(?:[^$\n\\]|\\.|\n(?!\s*\n))+?\$|\\\(.+?\\\)|\\\[.+?\\\]"
    r"|\\begin\{(equation|align|gather|multline|eqnarray|displaymath|math|alignat|flalign)(\*?)\}.*?\\end\{\1\2\}|<math\b[^<>]*>.*?</math\s*>",
    re.S | re.I,
)
#: LaTeX commands whose argument is no text.
_NO_TEXT = "cite|citep|citet|ref|eqref|label|footnote|footnotemark|pageref|includegraphics|bibliography|bibliographystyle|usepackage|documentclass|vspace|hspace|input|include|title|author|date"
_TEX_GONE = re.compile(rf"~?\\(?:{_NO_TEXT})\*?(?:\[[^\]\n]*\])?\{{[^{{}}]*\}}")
_TEX_CMD = re.compile(r"\\(?:[A-Za-z]+\*?(?=\{)|(?:item|maketitle|noindent|par|centering|hline|newline|linebreak|newpage|clearpage|tableofcontents|toprule|midrule|bottomrule|small|large|it|bf|em|tt)\b)")
_TEX_BRACE = re.compile(r"\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?\{|\\.|[{}]", re.S)
_TEX_FONT = re.compile(r"\{\\(?:em|it|bf|tt|sc|rm|sl|itshape|bfseries|ttfamily)\b\s*([^{}]*)\}")
_TEX_ESC = re.compile(r"\\([%$&#_{}])")
_SECTION = re.compile(r"\s*\\(?:part|chapter|section|subsection|subsubsection|paragraph|subparagraph)\*?(?:\[[^\]\n]*\])?\{((?:[^{}]|\{[^{}]*\})*)\}")
_ENV = re.compile(r"\s*\\(begin|end)\{([A-Za-z]+\*?)\}(?:\[[^\]\n]*\])?(?:\{[^{}\n]*\})?")
_WIKI_HEAD = re.compile(r"\s*(={2,6})\s*([^=\s].*?)\s*\1\s*$")
_ATX = re.compile(r" {0,3}(#{1,6})[ \t]+(\S.*)$")
_ITEM = re.compile(r"\s*(?:[-+•]|\*+|(\d+)[.)])[ \t]+(\S.*)$")
_CLASS = re.compile(r"\bclass\s*=\s*(?:\"\s*([\w-]+)|'\s*([\w-]+)|([\w-]+))", re.I)
_RULER = re.compile(r"(?:=+|-{3,})\s*$")
_ROW = re.compile(r"\s*\|.*\|\s*$")

#: Inline marks, by what their text becomes. Applied only where the character they begin with is found.
_INLINE = (
    ("`", re.compile(r"(`+)(?!`)([^\n]+?)(?<!`)\1(?!`)"), r"\2"),
    ("'''", re.compile(r"'''([^\n]+?)'''"), r"\1"),
    ("''", re.compile(r"''([^\n]+?)''"), r"\1"),
    ("[[", re.compile(r"\[\[(?:Category|File|Image):[^\[\]]*\]\]", re.I), ""),
    ("[[", re.compile(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]+)\]\]"), r"\1"),
    ("{{", re.compile(r"\{\{nowrap\|([^{}]*)\}\}", re.I), r"\1"),
    ("{{", re.compile(r"\{\{[A-Za-z][^{}]*\}\}"), ""),
    ("](", re.compile(r"!?\[([^\[\]\n]*)\]\([^()\s]*(?:\s+\"[^\"\n]*\")?\)"), r"\1"),
    ("[http", re.compile(r"\[https?://\S+ ([^\[\]\n]+)\]"), r"\1"),
    ("[^", re.compile(r"\[\^\w{1,20}\]:?"), ""),
    ("**", re.compile(r"\*\*(?=\S)([^\n]+?)(?<=\S)\*\*"), r"\1"),
    ("__", re.compile(r"(?<!\w)__(?=\S)([^\n]+?)(?<=\S)__(?!\w)"), r"\1"),
    ("~~", re.compile(r"~~(?=\S)([^\n]+?)(?<=\S)~~"), r"\1"),
    ("*", re.compile(r"(?<![\w*\\])\*(?=[^\s*])([^*\n]+?)(?<=[^\s*])\*(?![\w*])"), r"\1"),
    ("_", re.compile(r"(?<![\w_\\])_(?=[^\s_])([^_\n]+?)(?<=[^\s_])_(?!\w)"), r"\1"),
)
_REF = re.compile(r"<ref\b" + _ATTRS + r"(?<!/)>.*?</ref\s*>", re.I | re.S)
_MARK = re.compile("[\x02\x03](\\d+)[\x02\x03]")
_PUNCT = frozenset(".,;:!?")


@dataclass
class Node:
    path: str
    kind: str
    text: str
    level: int = 0
    linked: int = 0

    @property
    def leaf(self) -> str:
        """The path down to the leaf: a text that stands wholly in a link has the link's."""
        return f"{self.path}/a" if self.linked and self.linked >= len(self.text) else self.path


@dataclass
class Parsed:
    nodes: list[Node] = field(default_factory=list)
    marked: bool = False


def _code_blocks(t: str) -> tuple[str, list[tuple[str, str]]]:
    """The text with each code block replaced by \\x02number\\x02 on a line of its own, and the blocks (path, code)."""
    out, blocks, at = [], [], 0
    for m in iter(lambda: _CODE.search(t, at), None):
        s, e = m.start(), m.end()
        first = m.group()[0]
        if first in "`~":
            line = t.rfind("\n", 0, s) + 1
            run = re.compile(re.escape(first) + "{3,}").match(t, s)
            eol = t.find("\n", s)
            eol = len(t) if eol < 0 else eol
            if t[line:s].strip(" ") or first == "`" and "`" in t[run.end() : eol]:
                out.append(t[at : run.end()])
                at = run.end()
                continue
            close = re.compile(r"^[ ]{0,3}" + re.escape(first) + "{%d,}[ \\t]*$" % len(run.group()), re.M).search(t, min(eol + 1, len(t)))
            body, stop = (t[eol + 1 : close.start()], close.end()) if close else (t[eol + 1 :], len(t))
            path, s = "md/fence", line
        else:
            name = m.group(1) or m.group(2)
            end = re.compile(r"\\end\{%s\*?\}" % re.escape(name) if first == "\\" else r"</%s\s*>" % re.escape(name), re.I).search(t, e)
            body, stop = (t[e : end.start()], end.end()) if end else (t[e:], len(t))
            path = f"tex/{name}" if first == "\\" else f"html/{name.lower()}"
            if first == "<":
                if m.group().endswith("/>"):
                    out.append(t[at:e])
                    at = e
                    continue
                body = html.unescape(re.sub(r"</?code\b[^<>]*>", "", body))
            else:
                body = re.sub(r"\A\[[^\]\n]*\]", "", body)
        out.append(t[at:s])
        out.append(f"\n\x02{len(blocks)}\x02\n")
        blocks.append((path, body.strip("\n")))
        at = stop
    out.append(t[at:])
    return "".join(out), blocks


def _formulas(t: str) -> tuple[str, list[str]]:
    out, found, at = [], [], 0
    ticks = seen = 0  # back ticks of the line up to here
    for m in iter(lambda: _MATH.search(t, at), None):
        s, e, f = m.start(), m.end(), m.group()
        line = t.rfind("\n", seen, s)
        ticks, seen = (t.count("`", line + 1, s) if line >= 0 else ticks + t.count("`", seen, s)), s
        money = f[0] == "$" and f[1] != "$" and (f[-2].isspace() or t[e : e + 1].isdigit())
        if money or ticks % 2 or s and t[s - 1] == "\\":
            out.append(t[at : s + 1])
            at = s + 1
            continue
        out.append(t[at:s] + f"\x03{len(found)}\x03")
        found.append(f)
        at = e
    out.append(t[at:])
    return "".join(out), found


def _bare_formula(f: str) -> str:
    if f[0] == "$":
        return f.strip("$").strip()
    if f[0] == "<":
        f = re.sub(r"<mfrac>\s*(<m\w+>.*?</m\w+>)\s*(<m\w+>.*?</m\w+>)\s*</mfrac>", r"(\1)/(\2)", f, flags=re.S)
        return html.unescape(re.sub(r"<[^<>]*>", "", f)).strip()
    if f.startswith("\\begin"):
        return re.sub(r"\\(?:begin|end)\{[^{}]*\}", "", f).strip()
    return f[2:-2].strip()


class _Tag(str):
    """A tag's name, with the label that paths have: name.class"""

    label = ""


class _Parser:
    def __init__(self):
        self.p = Parsed()
        self.stack: list[str] = []

    def path(self, leaf: str = "") -> str:
        tags = [getattr(x, "label", x) for x in self.stack]
        return "/".join([*tags, leaf] if leaf else tags) or "text"

    def emit(self, kind: str, text: str, leaf: str, level: int = 0) -> None:
        self.p.nodes.append(Node(self.path(leaf), kind, text, level))


def _bare_arguments(t: str) -> str:
    """The text with every command that has a braced argument replaced by the argument, however deep; other braces stay."""
    open_at, gone = [], []
    for m in _TEX_BRACE.finditer(t):
        c = m.group()
        if c == "}":
            if open_at and (start := open_at.pop()):
                gone += [start, m.span()]
        elif c[-1] == "{" and (c == "{" or len(c) > 2):
            open_at.append(None if c == "{" else m.span())
    out, at = [], 0
    for s, e in sorted(gone):
        out.append(t[at:s])
        at = e
    return "".join(out) + t[at:]


def _inline(t: str, p: Parsed) -> str:
    """The text of one node without its inline marks."""
    if "\\" in t:
        u = _TEX_FONT.sub(r"\1", _TEX_GONE.sub("", t))
        u = _TEX_CMD.sub("", _bare_arguments(u))
        u = _TEX_ESC.sub(r"\1", u)
        if u != t:
            p.marked = True
            t = u.replace("~", " ") if "~~" not in u else u
    for mark, pattern, new in _INLINE:
        if mark in t:
            t, n = pattern.subn(new, t)
            if n:
                p.marked = True
    if "&" in t and _ENTITY.search(t):
        u = html.unescape(t)
        if u != t:
            p.marked = True
            t = u
    return " ".join(t.split())


def parse(body: str) -> Parsed:
    """The nodes of a body in reading order, and whether it holds any markup."""
    q = _Parser()
    p = q.p
    t = body.replace("\r\n", "\n").replace("\x02", "").replace("\x03", "")
    t, blocks = _code_blocks(t)
    whole = body
    while "lt;" in t and _ESCAPED.search(t):  # escaped once, or more often, too many
        whole = html.unescape(whole)
        p.marked = True
        t, blocks = _code_blocks(whole.replace("\r\n", "\n").replace("\x02", "").replace("\x03", ""))
    if blocks:
        p.marked = True
    if "<" in t:
        u = _HIDDEN.sub(" ", t)
        if u != t:
            p.marked, t = True, u
    if "\\documentclass" in t or "\\begin{document}" in t:
        p.marked = True
        at = t.find("\\begin{document}")
        t = t[at + 16 :] if at >= 0 else t
    if t.startswith("---\n") and (end := t.find("\n---\n", 3)) > 0:
        p.marked, t = True, t[end + 5 :]
    formulas: list[str] = []
    if "$" in t or "\\" in t or "<math" in t or "<MATH" in t:
        t, formulas = _formulas(t)
        if formulas:
            p.marked = True
    if "<ref" in t:
        t, n = _REF.subn("", t)
        p.marked |= n > 0
    if "<" in t:
        _html(t, q)
    else:
        _lines(t, q)
    out = []
    for node in p.nodes:  # code blocks and formulas stand where they were
        if node.kind == "code_block":
            path, code = blocks[int(node.text)]
            node.path, node.text = f"{node.path}/{path}", code
            out.append(node)
            continue
        marks = [int(m) for m in _MARK.findall(node.text)] if "\x03" in node.text else []
        if marks:
            node.text = _MARK.sub(lambda m: f"${_bare_formula(formulas[int(m.group(1))])}$", node.text)
        if node.kind == "paragraph" and len(marks) == 1 and not _MARK.sub("", f"\x03{marks[0]}\x03").strip() and node.text.startswith("$") and node.text.count("$") == 2 and node.text.endswith("$"):
            node.kind = "formula"
            node.text = node.text[1:-1]
            out.append(node)
        else:
            out.append(node)
            out += [Node(f"{node.path}/formula", "formula", _bare_formula(formulas[m]), -1) for m in marks]
    p.nodes = out
    return p


def _html(t: str, q: _Parser) -> None:
    """Splits the text at block tags, keeping the stack of open elements; inline tags just go."""
    p = q.p
    at, pieces = 0, []
    head = None
    in_link, linked = False, 0

    def flush() -> None:
        nonlocal head, linked
        s = "".join(pieces)
        pieces.clear()
        first, own, linked = len(p.nodes), linked, 0
        put(s)
        if own:  # what stands in links, in equal parts of all that the piece became
            part = min(1.0, own / max(1, len(" ".join(s.split()))))
            for n in p.nodes[first:]:
                n.linked = math.ceil(part * len(n.text))

    def put(s: str) -> None:
        nonlocal head
        if head is not None:
            text = _inline(_marks_out(s, q), p)
            q.emit(head, text, "", int(q.stack[-1][1]) if q.stack and q.stack[-1][:1] == "h" and q.stack[-1][1:].isdigit() else 1)
            head = None
        elif s.strip():
            _lines(s, q)

    for m in _TAG.finditer(t):
        name = m.group(2).lower()
        if name not in _KNOWN:
            continue
        p.marked = True
        pieces.append(t[at : m.start()])
        if in_link:
            linked += len(" ".join(pieces[-1].split()))
        at = m.end()
        if name not in _BLOCK:
            if name == "br":
                pieces.append(" ")
            elif name == "a":
                in_link = not m.group(1)
            continue
        if m.group(1):
            flush()
            if name in q.stack:
                while q.stack.pop() != name:
                    pass
            continue
        if name in ("p", "div") and head == "list_item" and not "".join(pieces).strip():
            continue  # a paragraph in a list item is the item's text
        flush()
        if name == "li":
            deepest = max((i for i, x in enumerate(q.stack) if x in ("ul", "ol")), default=-1)
            if "li" in q.stack[deepest + 1 :]:  # an item that wasn't closed
                del q.stack[deepest + 1 + q.stack[deepest + 1 :].index("li") :]
        elif name in ("p", "tr", "td", "th") and q.stack and q.stack[-1] == name:
            q.stack.pop()
        if name not in ("hr",):
            tag = _Tag(name)
            c = _CLASS.search(m.group(3)) if "class" in m.group(3).lower() else None
            tag.label = f"{name}.{c[1] or c[2] or c[3]}" if c else name
            q.stack.append(tag)
        if len(name) == 2 and name[0] == "h" and name[1].isdigit():
            head = "heading"
        elif name == "li":
            head = "list_item"
    pieces.append(t[at:])
    if in_link:
        linked += len(" ".join(pieces[-1].split()))
    flush()


def _marks_out(s: str, q: _Parser) -> str:
    """Code blocks inside a heading or list item come behind it."""
    if "\x02" in s:
        for m in re.findall("\x02(\\d+)\x02", s):
            q.emit("code_block", m, "")
        s = re.sub("\x02\\d+\x02", " ", s)
    return s


def _lines(t: str, q: _Parser) -> None:
    """Blocks of lines: Markdown, wiki and LaTeX structure."""
    p = q.p
    if not t.strip():
        return
    lines = t.split("\n")
    held: list[str] = []
    hash_run = [False] * len(lines)
    if "#" in t:
        marks = [bool(_ATX.match(x)) for x in lines]
        for i, x in enumerate(marks):
            hash_run[i] = x and (i > 0 and marks[i - 1] or i + 1 < len(lines) and marks[i + 1])
    simple = not q.stack

    def flush() -> None:
        if held:
            s = _inline(" ".join(held), p)
            if s:
                q.emit("paragraph", s, "" if q.stack else "p")
            held.clear()

    for i, line in enumerate(lines):
        s = line.strip()
        if not s:
            flush()
            continue
        c = s[0]
        if c.isalpha() and not s.startswith("|"):
            if i + 1 < len(lines) and lines[i + 1][:1] in ("=", "-") and _RULER.match(lines[i + 1]) and not held and len(lines[i + 1].strip()) >= 2:
                p.marked = True
                q.emit("heading", _inline(s, p), "md/setext", 1 if lines[i + 1][0] == "=" else 2)
                continue
            held.append(s)
            continue
        if c == "\x02":
            flush()
            q.emit("code_block", s.strip("\x02"), "")
            continue
        if c in "=-" and _RULER.match(s) and (c == "=" or len(s) >= 3):
            if i and p.nodes and p.nodes[-1].path.endswith("md/setext") and lines[i - 1].strip():
                continue
            if c == "-":
                flush()
                p.marked = True
                continue
        if c == "=" and (m := _WIKI_HEAD.match(s)):
            flush()
            p.marked = True
            q.emit("heading", _inline(m.group(2), p), "wiki/h", len(m.group(1)))
            continue
        if c == "#" and (m := _ATX.match(line)):
            flush()
            p.marked = True
            if hash_run[i]:
                q.emit("list_item", _inline(m.group(2), p), "wiki/ol/li", len(m.group(1)))
            else:
                q.emit("heading", _inline(m.group(2).rstrip("# "), p), "md/h", len(m.group(1)))
            continue
        if c == "\\":
            if m := _SECTION.match(s):
                flush()
                p.marked = True
                q.emit("heading", _inline(m.group(1), p), "tex/section", 1 + s.count("sub", 0, 14))
                s = s[m.end() :].strip()
                if s:
                    held.append(s)
                continue
            if m := _ENV.match(s):
                flush()
                p.marked = True
                name = m.group(2)
                if m.group(1) == "begin":
                    q.stack.append(name)
                elif name in q.stack:
                    while q.stack.pop() != name:
                        pass
                s = s[m.end() :].strip()
                if not s:
                    continue
                c = s[0]
            if s.startswith("\\item") and not s[5:6].isalpha():
                for part in re.split(r"\\item(?![A-Za-z])(?:\[[^\]\n]*\])?", s)[1:]:
                    flush()
                    p.marked = True
                    q.emit("list_item", _inline(part, p), "item")
                continue
            held.append(s)
            continue
        if c == "%" and not s[1:2].isdigit():
            p.marked = True
            continue
        if (c in "-+*•" or c.isdigit()) and (m := _ITEM.match(line)) and not (held and len(m.group(1) or "") > 3):
            flush()  # a long number that begins a line within a paragraph is a year or the like
            p.marked = True
            q.emit("list_item", _inline(m.group(2), p), "md/li", len(line) - len(line.lstrip()))
            continue
        if c == "{" and s.startswith("{|") or c == "|" and (s.startswith(("|-", "|}", "|+")) or _ROW.match(s) or "||" in s or "table" in q.stack or s.startswith("| ")):
            flush()
            p.marked = True
            cells = [_inline(x, p) for x in re.split(r"\|\|?", s.strip("{|}")) if x.strip(" -:+")]
            if cells and not s.startswith(("{|", "|-", "|}")):
                q.emit("table_row", " | ".join(cells), "table/tr")
            continue
        if c == "!" and s.startswith("! "):
            flush()
            p.marked = True
            q.emit("table_row", " | ".join(_inline(x, p) for x in s[1:].split("!!")), "table/tr")
            continue
        held.append(s)
    flush()
    if simple:
        del q.stack[:]


def path_scores(nodes: list[Node]) -> dict[str, float]:
    """Fused, smoothed tag-path ratio of every path. The ratio of text is the logarithm of its own characters per node of
    the path (lengths are skewed), times their share of all its characters; that of punctuation its marks per node. They are
    fused by weighting the one with the other."""
    sums: dict[str, list[float]] = {}
    for n in nodes:
        s = sums.setdefault(n.leaf, [0.0, 0.0, 0.0, 0.0])
        s[0] += max(0, len(n.text) - n.linked)
        s[1] += len(n.text)
        s[2] += sum(map(n.text.count, _PUNCT)) if n.linked < len(n.text) else 0
        s[3] += 1
    fused = {k: math.log1p(own / n) * (own / max(1, size)) * (1 + math.log1p(marks / n)) for k, (own, size, marks, n) in sums.items()}
    # smoothing: a node's ratio with those of its neighbours in reading order, weighted by distance
    seq = [fused[n.leaf] for n in nodes]
    weights = [math.exp(-3 * d * d) for d in range(3)]
    smooth: dict[str, list[float]] = {}
    for i, n in enumerate(nodes):
        total = norm = 0.0
        for d in range(-2, 3):
            if 0 <= i + d < len(seq):
                total += weights[abs(d)] * seq[i + d]
                norm += weights[abs(d)]
        s = smooth.setdefault(n.leaf, [0.0, 0.0])
        s[0] += total / norm
        s[1] += 1
    return {k: a / n for k, (a, n) in smooth.items()}


#: A path is content from this share of the mean score of its document's running text.
THRESHOLD = 0.15


def _section(nodes: list[Node], keep: list[bool], i: int) -> bool | None:
    """Whether the section of heading i holds content; None if it holds nothing. It ends at a heading of the same or a higher
    level, and where the element ends that the heading stands in."""
    inside = nodes[i].path.split("/")[: -1 if nodes[i].path.rsplit("/", 1)[-1][:1] == "h" and not nodes[i].path.endswith(("wiki/h", "md/h")) else -2]
    within = "/".join(inside)
    some = None
    for j in range(i + 1, len(nodes)):
        n = nodes[j]
        if n.kind == "heading" and n.level <= nodes[i].level or within and n.path != within and not n.path.startswith(within + "/"):
            break
        if n.kind != "heading":
            if keep[j]:
                return True
            some = False
    return some


def select_content(nodes: list[Node], threshold: float = THRESHOLD) -> list[Node]:
    """The content nodes, in order: those of paths that reach the threshold, and all code and formulas. A heading is content
    if anything of its section is; one with nothing below it if its path reaches the threshold or what it follows is content."""
    if not nodes:
        return []
    scores = path_scores(nodes)
    # of running text: long code or tables say nothing about what a paragraph must have
    text = [n for n in nodes if n.kind == "paragraph" and n.linked < len(n.text)] or nodes
    cut = threshold * sum(scores[n.leaf] for n in text) / len(text)
    keep = [n.kind in ("code_block", "formula") or scores[n.leaf] >= cut for n in nodes]
    for i, n in enumerate(nodes):
        if n.kind == "heading":
            some = _section(nodes, keep, i)
            keep[i] = some if some is not None else keep[i] or i > 0 and keep[i - 1]
    return [n for n, k in zip(nodes, keep, strict=True) if k]


def render(nodes: list[Node]) -> str:
    """Clean text in one plain convention: '# ' headings, '- ' items, fenced code, $formulas$."""
    out: list[str] = []
    last = ""
    for n in nodes:
        if n.kind == "formula" and n.level == -1:
            continue  # stands in its sentence
        if n.kind == "heading":
            s = "# " + n.text
        elif n.kind == "list_item":
            s = "- " + n.text
        elif n.kind == "code_block":
            s = f"```\n{n.text}\n```"
        elif n.kind == "formula":
            s = f"$$ {n.text} $$"
        else:
            s = n.text
        if out:
            out.append("\n" if n.kind == last and n.kind in ("list_item", "table_row") else "\n\n")
        out.append(s)
        last = n.kind
    return "".join(out)


CLEANED = "id long, marked boolean, clean_text string, elements array<struct<element:string,text:string>>"


def cleaned(df: DataFrame, id_col: str = "id", body_col: str = "body") -> DataFrame:
    """CLEANED rows: whether the body holds any markup, its clean text, and its elements in reading order.

    Null bodies give a null text and no elements; plain bodies come through with their paragraphs. Whole bodies of any
    length are parsed; repeated rows give their rows again. Indented lines are no code blocks: nested lists look the same.
    """

    def run(batches):
        for pdf in batches:
            out = []
            for rid, body in zip(pdf["id"].to_list(), pdf["body"], strict=True):
                if body is None:
                    out.append((rid, False, None, []))
                    continue
                p = parse(body)
                nodes = select_content(p.nodes)
                out.append((rid, p.marked, render(nodes), [{"element": n.kind, "text": n.text} for n in nodes if n.kind in ELEMENTS] if p.marked else []))
            yield pd.DataFrame(out, columns=["id", "marked", "clean_text", "elements"])

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(body_col).alias("body")).mapInPandas(run, CLEANED)


def element_rows(clean: DataFrame) -> DataFrame:
    """(id, element, seq): one row (id, 'any', 0) for every marked body and one for each element, numbered per kind."""
    marked = clean.where("marked").select("id", "elements.element")
    span = lambda e, lo, hi: F.struct(F.lit(e).alias("element"), F.lit(lo).alias("lo"), hi.alias("hi"))
    found = lambda e: F.size(F.filter("element", lambda x: x == e))
    counts = F.array(span("any", 0, F.lit(0)), *[span(e, 1, found(e)) for e in ELEMENTS])
    each = marked.select("id", F.explode(counts).alias("c")).where("c.hi >= c.lo")
    return each.select("id", "c.element", F.explode(F.sequence("c.lo", "c.hi")).alias("seq"))
