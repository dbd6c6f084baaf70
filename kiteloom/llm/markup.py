"""Markup residue: which kinds of markup a text holds, and the text without it but with its structure.

HTML, Markdown, wiki and LaTeX are read into one stream of nodes, each with its path of tags from the root; lines of HTML are cut
at the tags of blocks, so a path is that of the tree even where all of it stands in one line. Per path, text length and
punctuation are summed, smoothed over neighbouring paths and fused to one tag-path ratio, which weighs less what a tag of
its path says is furniture (navigation, footers, advertisements, links alone). Ratios decide on every path that goes through an
HTML container; text and structure outside of them (headings, lists, tables, code, formulas) is content. The clean form
writes headings as ``# ``, items as ``- ``, cells between `` | ``, code between fences and formulas between dollars, whatever
markup they came from. Runs of any length are read: what opens is looked for to the end of its paragraph, and no further than the
next of its kind that opens, so reading stays linear.
"""

from __future__ import annotations

import functools
import html
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

KINDS = ("html", "latex", "markdown", "wiki")
#: Element names of HTML.
_TAGS = (
    "a abbr address article aside b big blockquote body br button caption center cite code col dd del details div dl dt em figcaption figure font footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html i iframe img input ins kbd label li link main mark meta nav ol option p pre q s samp script section select small span strike strong style sub summary sup "
    "table tbody td textarea tfoot th thead time title tr tt u ul var video wbr"
).split()
#: LaTeX commands that need no argument.
_BARE = (
    "item ldots dots cdots alpha beta gamma delta epsilon varepsilon zeta eta theta iota kappa lambda mu nu xi pi rho sigma tau phi varphi chi psi omega Gamma Delta Theta Lambda Xi Pi "
    "Sigma Phi Psi Omega le leq ge geq ne neq approx times cdot pm infty sum prod int frac sqrt rightarrow leftarrow to in forall exists partial nabla hline centering noindent newline "
    "newpage LaTeX TeX maketitle tableofcontents par quad qquad left right textbackslash"
).split()
_SECTIONS = {"part": 1, "chapter": 1, "section": 2, "subsection": 3, "subsubsection": 4, "paragraph": 5}
_DROPPED = ("label", "cite", "citep", "citet", "ref", "eqref", "pageref", "footnote", "footnotemark", "index", "vspace", "hspace", "includegraphics", "bibliography", "usepackage", "documentclass", "input")

_TAG = rf"</?(?:{'|'.join(_TAGS)})(?:\s+[A-Za-z_:][\w:.-]*(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'<>=`]+))?)*\s*/?>"
_PAGE = r"<!--\s*(?:page|第)?\s*\d+\s*(?:页)?\s*-->"
_CODE = re.compile(
    r"(?P<fence>^[ \t]{0,3}(?P<tick>```+|~~~+)[^\n`]*\n(?:.*?\n)?[ \t]{0,3}(?P=tick)[ \t]*$)"
    r"|(?P<pre><pre\b[^>]*>.*?</pre\s*>)"
    r"|(?P<htmlcode><code\b[^>]*>.*?</code\s*>)"
    r"|(?P<verb>\\begin\{(?P<env>verbatim|lstlisting|minted)\*?\}.*?\\end\{(?P=env)\*?\})"
    r"|(?P<tick1>(?<![`\\])`(?!`)(?:[^`\n]|\n(?!\s*\n))+`(?!`))",
    re.M | re.S | re.I,
)
_CODE_KIND = {"fence": "markdown", "tick1": "markdown", "pre": "html", "htmlcode": "html", "verb": "latex"}
_IN = r"(?:[^\n]|\n(?!\s*\n))"
_MATH_DOLLAR = r"\$(?![\s$\d])[^$\n]*?(?<![\s$])\$(?!\d)|\$(?=\d+[^$\n]*?[\\^_=])[^$\n一-鿿]+?(?<![\s$])\$(?!\d)"
_DISPLAY = rf"\\\[(?:(?!\\\[){_IN})+?\\\]"
_ROUND = rf"\\\((?:(?!\\\(){_IN})+?\\\)"
_DOLLARS = rf"\$\$(?:(?!\$\$){_IN})+\$\$"
_FIND = {
    "html": re.compile(rf"(?i:{_TAG})|<!--(?!\s*(?:page|第)?\s*\d+\s*(?:页)?\s*-->)(?:[^-<]|-(?!->)|<(?!!--))*-->", re.I),
    "latex": re.compile(
        r"\\(?:begin|end)\{[A-Za-z]+\*?\}|\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?\{|"
        rf"(?<![A-Za-z:\\])\\(?:{'|'.join(_BARE)})(?![A-Za-z\\])|{_DISPLAY}|{_ROUND}|(?<!\\){_DOLLARS}|(?<=[\w\s])\\[%&#_$](?![\w]*\\)|{_MATH_DOLLAR}",
    ),
    "wiki": re.compile(
        rf"'''?(?=[^\s']){_IN}+?'''?|\[\[[^\[\]\n]+\]\]|\{{\{{[^{{}}\n]+\}}\}}|^[ \t]*(={{2,6}})[ \t]*[^=\n]+[ \t]*\1[ \t]*$|^[ \t]*\{{\|.*$|^[ \t]*\|\}}[ \t]*$|^[ \t]*\|-[ \t]*$",
        re.M,
    ),
    "markdown": re.compile(
        r"^[ \t]{0,3}#{1,6}[ \t]+\S|"
        rf"(?<![\\*])(\*{{1,3}})(?=[^\s*])(?:[^*\n]|\n(?!\s*\n))+?(?<=[^\s*])\1(?!\*)|(?<!_)__(?=[^\s_])(?:(?!__){_IN})+?(?<=[^\s_])__(?!_)|(?<![A-Za-z0-9_])_(?=[^\s_])(?:[^_\n]|\n(?!\s*\n))+?(?<=[^\s_])_(?![A-Za-z0-9_])|"
        rf"~~(?=[^\s~])(?:(?!~~){_IN})+?~~|!?\[(?:[^\[\]\n]|\n(?!\s*\n))*\]\([^()\s]+(?:\s+\"[^\"\n]*\")?\)|\[\^[\w-]+\]|"
        r"^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)+\|?[ \t]*$",
        re.M,
    ),
}
_ITEM = re.compile(r"^[ \t]*[-*+][ \t]+(?!\d+[ \t]*(?:-|$))(?=[^\W\d_]|[`\"'“《(（\x00*_\[<])")
_QUOTE = re.compile(r"^[ \t]{0,3}>[ \t]*(?=[^\W\d_]|[\x00*_`\[\"“])")
_PUNCT = re.compile(r"[,.;:!?，。；：！？、…]")
_CELL = re.compile(r"</t[dh]>\s*<t[dh][^>]*>", re.I)


def _entity(m: re.Match) -> bool:
    return html.unescape(m.group()) != m.group()


_ENTITY = re.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});")


def _hide_code(text: str) -> tuple[str, list[tuple[str, str]]]:
    """The text with each code block replaced by one placeholder, and the blocks with their kind of delimiter."""
    blocks: list[tuple[str, str]] = []

    def put(m: re.Match) -> str:
        kind = m.lastgroup if m.lastgroup in _CODE_KIND else next(k for k in _CODE_KIND if m.group(k))
        blocks.append((kind, m.group()))
        return f"\x00{len(blocks) - 1}\x00"

    return _CODE.sub(put, text.replace("\x00", "")), blocks


def _marked_lines(lines: list[str]) -> Iterator[int]:
    """Lines that are a list item or a quotation and not the wrapped end of a sentence."""
    for i, line in enumerate(lines):
        before = lines[i - 1].rstrip() if i else ""
        if _ITEM.match(line):
            mark = line.lstrip()[0]
            if mark == "-" or not before or _ITEM.match(before):
                yield i
        elif _QUOTE.match(line) and (not before or before[-1] in ".。!！?？:：>|`}\x00" or before.lstrip()[0] in "#=>|" or len(before) > 1 and before[-1] in "=)"):
            yield i


_ELSEWHERE = re.compile(rf"\\[A-Za-z]+\*|{_DISPLAY}|{_ROUND}|{_DOLLARS}|^[ \t]*\{{\|(?:(?!^[ \t]*\{{\|)(?s:.))*?^[ \t]*\|\}}|\[\[[^\]\n]*\]\]|\{{\{{[^{{}}\n]*\}}\}}", re.M)


def _marks(bare: str, blocks: list[tuple[str, str]]) -> list[tuple[int, str]]:
    """Where markup begins in a text whose code is hidden, and its kind, in order."""
    out = {(m.start(), _CODE_KIND[blocks[int(m.group(1))][0]]) for m in re.finditer(r"\x00(\d+)\x00", bare)}
    for kind in ("html", "latex", "wiki"):
        out |= {(m.start(), kind) for m in _FIND[kind].finditer(bare)}
    out |= {(m.start(), "html") for m in _ENTITY.finditer(bare) if _entity(m)}
    # signs of Markdown inside LaTeX and wiki markup aren't Markdown
    parts, at, size, end = [], [], 0, 0
    for m in [*_ELSEWHERE.finditer(bare), None]:
        part = bare[end : m.start() if m else None] + " " * (m is not None)
        at.append((size, end))
        parts.append(part)
        size, end = size + len(part), m.end() if m else 0
    plain = "".join(parts)

    def place(k: int) -> int:
        start, origin = at[bisect_right(at, (k, len(bare) + 1)) - 1]
        return origin + k - start

    out |= {(place(m.start()), "markdown") for m in _FIND["markdown"].finditer(plain)}
    lines = plain.split("\n")
    starts = [0, *accumulate(len(x) + 1 for x in lines)]
    out |= {(place(starts[i]), "markdown") for i in _marked_lines(lines)}
    return sorted(out)


@functools.lru_cache(64)
def _closed(text: str) -> dict[int, int]:
    """Of each brace that opens a group the position after the one that closes it."""
    out, held = {}, []
    for m in re.finditer(r"(?<!\\)[{}]", text):
        if m.group() == "{":
            held.append(m.start())
        elif held:
            out[held.pop()] = m.end()
    return out


def _braced(text: str, at: int) -> int:
    """The position after the group that opens at ``at``; the next one if it never closes."""
    return _closed(text).get(at, at + 1)


_COMMAND = re.compile(r"~?\\([A-Za-z]+)\*?(?:\[[^\]\n]*\])?(?=\{)")


def _latex_inline(s: str) -> str:
    out, i = [], 0
    for m in iter(lambda: _COMMAND.search(s, i), None):
        end = _braced(s, m.end())
        out.append(s[i : m.start()])
        if m.group(1) not in _DROPPED:
            out.append(_latex_inline(s[m.end() + 1 : end - 1]))
        i = end
    out.append(s[i:])
    return re.sub(r"\\([%&#_$])", r"\1", "".join(out))


_MATH = re.compile(rf"({_DISPLAY})|({_ROUND})|({_DOLLARS})|({_MATH_DOLLAR})")


def _inline(s: str) -> str:
    """One line or cell without inline markup; formulas are kept between dollars."""
    kept: list[str] = []

    def math(m: re.Match) -> str:
        body = m.group()[2:-2] if m.lastindex < 4 else m.group()
        kept.append(f"${body.strip().strip('$').strip()}$")
        return f"\x01{len(kept) - 1}\x01"

    s = _MATH.sub(math, s)
    s = re.sub(rf"(?i){_PAGE}", lambda m: m.group().replace("<!--", "\x02").replace("-->", "\x03"), s)
    s = re.sub(r"<!--(?:[^-<]|-(?!->)|<(?!!--))*-->", "", s)
    s = re.sub(r"(?i)<br\s*/?>", "\n", s)
    s = re.sub(rf"(?i){_TAG}", "", s)
    s = re.sub(r"\[\[(?:File|Image|文件|图像):[^\]\n]*\]\]|\{\{[^{}\n]*\}\}", lambda m: m.group()[2:-2].split("|")[1] if m.group().startswith("{{term|") else "", s)
    s = re.sub(r"\[\[(?:[^\]|\n]*\|)?([^\]|\n]*)\]\]", r"\1", s)
    s = re.sub(r"!\[([^\]\n]*)\]\([^()\s]*(?:\s+\"[^\"\n]*\")?\)", r"\1", s)
    s = re.sub(r"\[([^\[\]\n]*)\]\([^()\s]+(?:\s+\"[^\"\n]*\")?\)", r"\1", s)
    s = re.sub(r"\[\^[\w-]+\]", "", s)
    s = re.sub(r"'''?(?=[^\s'])(.+?)'''?", r"\1", s)
    s = re.sub(r"(?<![\\*])(\*{1,3})(?=[^\s*])([^*\n]+?)(?<=[^\s*])\1(?!\*)", r"\2", s)
    s = re.sub(r"(?<!_)__(?=[^\s_])((?:(?!__).)+?)(?<=[^\s_])__(?!_)", r"\1", s)
    s = re.sub(r"(?<![A-Za-z0-9_])_(?=[^\s_])([^_\n]+?)(?<=[^\s_])_(?![A-Za-z0-9_])", r"\1", s)
    s = re.sub(r"~~(?=[^\s~])((?:(?!~~).)+?)~~", r"\1", s)
    s = _latex_inline(s)
    for _ in range(2):  # entities are sometimes escaped twice
        s = html.unescape(s)
    s = s.replace("\xa0", " ").replace("\x02", "<!--").replace("\x03", "-->")
    return re.sub(r"\x01(\d+)\x01", lambda m: kept[int(m.group(1))], s)


_OVER_LINES = re.compile(rf"{_DISPLAY}|{_DOLLARS}|<!--(?:[^-<]|-(?!->)|<(?!!--))*-->")
_EMPHASIS = re.compile(rf"(\*\*\*?|__|~~|''')(?=\S)((?:(?!\1){_IN})+?)(?<=\S)\1")
#: Elements at which a line is cut, and those that hold others.
_BLOCKS = "address article aside blockquote button center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header li main nav ol option p script section select style summary table textarea tr ul".split()
_HOLD = frozenset("address article aside blockquote button center details div dl fieldset figure footer form header main nav ol script section select style table textarea ul".split())
_BLOCK_TAG = re.compile(rf"<(/?)({'|'.join(_BLOCKS)})\b([^<>]*)>", re.I)
#: Words in an element's class or id that say it is furniture.
_FURNITURE = re.compile(r"(?:class|id)\s*=\s*[\"']?[^\"'>]*\b(?:ads?|advert\w*|banner|breadcrumbs?|cookies?|footer|menu|nav(?:bar|igation)?|popup|promo\w*|share|sidebar|social|sponsor\w*)\b", re.I)
_LINKS = re.compile(r"<a\b[^<>]*>.*?</a\s*>", re.I | re.S)


#: Elements that need not be closed, by the one they stand in.
_INNER = {"ul": ("li",), "ol": ("li",), "dl": ("dt", "dd"), "table": ("tr",), "select": ("option",)}


def _cut_at(text: str) -> frozenset[str]:
    """The elements of a text at whose tags lines are cut: those that some tag closes, and what may stand in them unclosed. A stray
    tag within a sentence cuts nothing."""
    closed = {m.group(2).lower() for m in _BLOCK_TAG.finditer(text) if m.group(1)} if "</" in text else set()
    return frozenset(closed.union(*(_INNER.get(c, ()) for c in closed)))


def _segments(line: str, at: frozenset[str]) -> list[str]:
    """A line cut before tags that open a block and after tags that close one."""
    if not at or "<" not in line:
        return [line]
    cuts = sorted({0, len(line), *(m.end() if m.group(1) else m.start() for m in _BLOCK_TAG.finditer(line) if m.group(2).lower() in at)})
    return [line[a:b] for a, b in zip(cuts, cuts[1:])] or [line]


def nodes(text: str) -> list[tuple[tuple[str, ...], str, frozenset[str]]]:
    """Path of tags, text and kinds of the markup that begins there of every node, in order. Lines with markup that
    yield no other node are nodes without text, ``mark``."""
    bare, blocks = _hide_code(text)
    bare = bare.replace("\r\n", "\n")
    marks, at = _marks(bare, blocks), 0
    # formulas, comments and emphasis may run over line ends; lines are read one by one
    bare = _OVER_LINES.sub(lambda m: m.group().replace("\n", " "), bare)
    bare = _EMPHASIS.sub(lambda m: m.group().replace("\n", " "), bare)
    found: list[tuple[tuple[str, ...], str]] = []
    out: list[tuple[tuple[str, ...], str, frozenset[str]]] = []
    stack: list[str] = []  # what the open elements are
    names: list[str] = []  # and how they are written

    def push(name: str, role: str | None = None) -> None:
        names.append(name)
        stack.append(role or name)

    def pop(name: str) -> None:
        """Up to the last element of that name, if one is open."""
        if name in names:
            k = len(names) - 1 - names[::-1].index(name)
            del names[k:], stack[k:]

    def put(tags: tuple[str, ...], s: str) -> None:
        def code(m: re.Match) -> str:
            kind, raw = blocks[int(m.group(1))]
            if kind in ("tick1", "htmlcode"):
                return html.unescape(re.sub(r"(?i)</?code[^>]*>", "", raw)).strip("`")
            return raw
        found.append(((*stack, *tags), re.sub(r"\x00(\d+)\x00", code, s).strip()))

    def close(end: int) -> None:
        """The line that ends there is read; what markup began in it goes to its first node."""
        nonlocal at
        first = at
        while at < len(marks) and marks[at][0] < end:
            at += 1
        own = frozenset(kind for _, kind in marks[first:at])
        if own and not found:
            found.append(((*stack, "mark"), ""))
        out.extend((path, s, own if not i else frozenset()) for i, (path, s) in enumerate(found))
        found.clear()

    line_end = 0
    cut_at = _cut_at(bare)
    for line, last in ((x, k == len(cut) - 1) for cut in (_segments(y, cut_at) for y in bare.split("\n")) for k, x in enumerate(cut)):
        line_end += len(line) + last
        s = line.strip()
        if m := re.fullmatch(r"\x00(\d+)\x00", s):
            kind, raw = blocks[int(m.group(1))]
            body = re.sub(r"(?i)</?(?:pre|code)[^>]*>", "", raw) if kind == "pre" else re.sub(r"\\(?:begin|end)\{[^}]*\}(?:\[[^\]]*\])?", "", raw) if kind == "verb" else "\n".join(raw.split("\n")[1:-1]) if kind == "fence" else raw.strip("`")
            found.append(((*stack, "pre"), (html.unescape(body) if kind == "pre" else body).strip("\n")))
            close(line_end)
            continue
        for m in re.finditer(r"\\begin\{(\w+)\*?\}", s):
            push("\\" + m.group(1), {"itemize": "ul", "enumerate": "ol", "tabular": "table", "equation": "math", "align": "math"}.get(m.group(1), "env"))
        ends = re.findall(r"\\end\{(\w+)\*?\}", s)
        s = re.sub(r"\\(?:begin|end)\{\w+\*?\}(?:\[[^\]]*\]|\{[^}]*\})?", "", s).strip()
        tags = [(slash, name.lower(), rest) for slash, name, rest in _BLOCK_TAG.findall(s)] if "<" in s else []
        for slash, name, rest in tags:
            if not slash and name in _HOLD and name in cut_at:
                push(name, "aside" if _FURNITURE.search(rest) else name)
        link = ("a",) if "<a" in s and not re.sub(rf"(?i){_TAG}", "", _LINKS.sub("", s)).strip() else ()
        if m := re.match(r"#{1,6}[ \t]+", s):
            put((f"h{len(m.group().strip())}",), _inline(s[m.end() :].rstrip("# ")))
        elif m := re.fullmatch(r"(={2,6})[ \t]*([^=]+?)[ \t]*\1", s):
            put((f"h{len(m.group(1))}",), _inline(m.group(2)))
        elif m := re.match(r"\\(\w+)\*?(?=\{)", s):
            end = _braced(s, m.end())
            if m.group(1) in _SECTIONS:
                put((f"h{_SECTIONS[m.group(1)]}",), _inline(s[m.end() + 1 : end - 1]))
                s = s[end:].strip()
            if s and (rest := _inline(s)).strip():
                put(("p",), rest)
        elif m := re.search(r"(?i)<h([1-6])\b[^>]*>(.*?)(?:</h\1>|$)", s):
            put((f"h{m.group(1)}",), _inline(m.group(2)))
        elif s.startswith("{|"):
            push("{|", "table")
        elif s == "|}":
            pop("{|")
        elif re.fullmatch(r"\|-+|\|?[ \t]*:?-{3,}:?[ \t]*(\|[ \t]*:?-{3,}:?[ \t]*)+\|?", s):
            pass
        elif s.startswith("|") and ("table" in stack or s.endswith("|") and s.count("|") > 1):
            put(("table", "tr") if "table" not in stack else ("tr",), " | ".join(_inline(c).strip() for c in re.split(r"\|\|?", s.strip("|"))))
        elif re.search(r"(?i)<t[dh]\b", s):
            put(("tr",) if "table" in stack else ("table", "tr"), " | ".join(_inline(c).strip() for c in _CELL.split(s)))
        elif re.search(r"(?i)<li\b", s) or s.startswith("\\item"):
            put(("li", *link) if {"ul", "ol"} & {*stack} else ("ul", "li", *link), _inline(s.removeprefix("\\item")))
        elif _ITEM.match(line):
            put(("ul", "li"), _inline(_ITEM.sub("", line)))
        elif re.fullmatch(r"\{\{[^{}]*\}\}|\[\[(?:File|Image|文件|图像):[^\]]*\]\]", s):
            put(("figure",), s.strip("{}[]").split("|")[-1] if s.startswith("[[") else "")
        elif re.fullmatch(r"\$\$.*\$\$|\\\[.*\\\]", s):
            put(("math",), _inline(s))
        elif _QUOTE.match(line):
            put(("blockquote",), _inline(_QUOTE.sub("", line)))
        elif tags and not re.sub(rf"(?i){_TAG}", "", s).strip():
            pass
        elif s or last:
            put(("p", *link) if s else ("gap",), _inline(s))
        for slash, name, _ in tags:
            if slash:
                pop(name)
        for name in ends:
            pop("\\" + name)
        close(line_end)
    return out


def kinds(text: str | None, seq: list | None = None) -> list[str]:
    """The kinds of markup of a text's nodes, in alphabetical order; null and empty texts have none. Paths that hold no
    content count as well: a comment or a figure is markup. seq: its nodes, if they are known."""
    if not text:
        return []
    if seq is None:
        bare, blocks = _hide_code(text)
        if not blocks and not _marks(bare.replace("\r\n", "\n"), blocks):  # no node would have one
            return []
        seq = nodes(text)
    return sorted(frozenset().union(*(k for _, _, k in seq)))


#: How much the ratio of a path weighs by what is on it: what a tag says is furniture weighs little.
WEIGHTS = {"nav": 0.2, "footer": 0.2, "aside": 0.2, "form": 0.3, "select": 0.1, "button": 0.2, "a": 0.3, "header": 0.5}
#: Elements that are never shown as text.
_UNSEEN = frozenset(("script", "style", "figure"))
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_OUTSIDE = _HEADINGS | frozenset("p ul ol li table tr pre math blockquote env".split())


def content_paths(seq: list, threshold: float = 0.03, furniture: float = 4.0) -> set[tuple[str, ...]]:
    """The paths of a text's nodes that hold content.

    Ratio: text a node, weighed by punctuation (a sentence has some) and by the path's tags. A path through an HTML container
    must reach ``threshold`` of the best path's, and, if one of its tags says it is furniture, ``furniture`` on its own; a heading in
    such a container needs only not to be in furniture. Paths outside of containers are content.
    """
    paths: dict[tuple[str, ...], list[float]] = {}
    for path, s, _ in seq:
        if path[-1] not in ("gap", "mark"):
            x = paths.setdefault(path, [0.0, 0.0, 0.0])
            x[0] += len(s)
            x[1] += len(_PUNCT.findall(s))
            x[2] += 1
    order = list(paths)

    def smooth(v: list[float]) -> list[float]:
        return [0.8 * v[i] + 0.1 * v[max(i - 1, 0)] + 0.1 * v[min(i + 1, len(v) - 1)] for i in range(len(v))]

    length = [paths[p][0] / paths[p][2] for p in order]
    marks = [min(1.0, paths[p][1] / paths[p][2]) for p in order]
    weight = [math.prod(WEIGHTS.get(t, 1.0) for t in p) for p in order]
    fuse = lambda a, b: [x * (0.1 + y) * w for x, y, w in zip(a, b, weight)]
    alone, fused = fuse(length, marks), fuse(smooth(length), smooth(marks))
    least = threshold * max(fused, default=0.0)
    out = set()
    for p, own, f, w in zip(order, alone, fused, weight):
        if _UNSEEN.isdisjoint(p) and (_OUTSIDE.issuperset(p) or f >= least and (w == 1.0 or own >= furniture) or p[-1] in _HEADINGS and w >= 0.5):
            out.add(p)
    return out


def clean(text: str | None, threshold: float = 0.03, seq: list | None = None) -> str | None:
    """The text without markup, its structure in one notation; null stays null. threshold: see ``content_paths``; seq: the text's
    nodes, if they are known."""
    if text is None:
        return None
    seq = nodes(text) if seq is None else seq
    content = content_paths(seq, threshold)
    out: list[str] = []
    for path, s, _ in seq:
        leaf = path[-1]
        if leaf == "gap":
            out.append("")
        elif path in content and s:
            if leaf in ("h1", "h2", "h3", "h4", "h5", "h6"):
                out.append(f"{'#' * int(leaf[1])} {s}")
            elif "li" in path[-2:]:
                out.append("  " * max(0, sum(t in ("ul", "ol") for t in path) - 1) + f"- {s}")
            elif leaf == "pre":
                out.append(f"```\n{s}\n```")
            else:
                out.append(s)
    return re.sub(r"\n{3,}", "\n\n", "\n".join(out)).strip("\n")


_RESULT = StructType([StructField("kinds", ArrayType(StringType())), StructField("clean", StringType())])


@F.pandas_udf(_RESULT)
def _both(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for s in parts:
        read = [(x, None if x is None else nodes(x)) for x in s]
        yield pd.DataFrame({"kinds": [kinds(x, seq) for x, seq in read], "clean": [clean(x, seq=seq) for x, seq in read]})


@F.pandas_udf(ArrayType(StringType()))
def _kinds(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield pd.Series([kinds(x) for x in s], dtype=object)


def without_markup(df: DataFrame, src: str, row_id: str, column: str) -> DataFrame:
    """``src, row_id, kinds, clean``: every row, also those without markup. A null text has no kinds and a null clean form.

    Texts are handled whole, however long; repeated rows each come out; other columns are dropped. Nothing is shuffled.
    """
    return df.select(F.lit(src).alias("src"), F.col(row_id).cast("bigint").alias("row_id"), _both(column).alias("x")).select("src", "row_id", "x.kinds", "x.clean")


def markup_kinds(df: DataFrame, src: str, row_id: str, column: str) -> DataFrame:
    """``src, row_id, markup``: one row for each kind of markup in each text."""
    marked = df.where(F.col(column).rlike(r"[<&\\$'\[{=#*_~`>|+-]"))
    return marked.select(F.lit(src).alias("src"), F.col(row_id).cast("bigint").alias("row_id"), F.explode(_kinds(column)).alias("markup"))
