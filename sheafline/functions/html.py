r"""HTML fragments of items to typeset text, blocks, and table grids.

The parser is the standard library's; conversion keeps state inside one fragment only, so it runs
as an Arrow-batched function over a text column.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

#: Characters and what they are in a formula.
MATH = {
    "＝": "=", "＋": "+", "－": "-", "＜": "<", "＞": ">", "～": r"\sim", "∶": ":", "−": "-", "–": "-", "—": "-",
    "×": r"\times", "÷": r"\div", "·": r"\cdot", "…": r"\dots", "⋯": r"\cdots", "≈": r"\approx", "≤": r"\le", "≥": r"\ge",
    "≠": r"\neq", "±": r"\pm", "∞": r"\infty", "∈": r"\in", "⊂": r"\subset", "∩": r"\cap", "∠": r"\angle", "∝": r"\propto",
    "∧": r"\wedge", "∨": r"\vee", "∴": r"\therefore", "≡": r"\equiv", "∼": r"\sim", "≪": r"\ll", "≫": r"\gg", "∥": r"\parallel",
    "⊥": r"\perp", "→": r"\to", "←": r"\leftarrow", "⇌": r"\rightleftharpoons", "⇒": r"\Rightarrow", "√": r"\sqrt{\phantom{1}}",
    "°": r"{^\circ}", "℃": r"{^\circ}C", "′": "'", "″": "''",
    "α": r"\alpha", "β": r"\beta", "γ": r"\gamma", "δ": r"\delta", "ε": r"\varepsilon", "ζ": r"\zeta", "η": r"\eta", "θ": r"\theta",
    "κ": r"\kappa", "λ": r"\lambda", "μ": r"\mu", "ν": r"\nu", "ξ": r"\xi", "π": r"\pi", "ρ": r"\rho", "σ": r"\sigma",
    "τ": r"\tau", "φ": r"\varphi", "χ": r"\chi", "ψ": r"\psi", "ω": r"\omega", "Γ": r"\Gamma", "Δ": r"\Delta", "Θ": r"\Theta",
    "Λ": r"\Lambda", "Ξ": r"\Xi", "Π": r"\Pi", "Σ": r"\Sigma", "Φ": r"\Phi", "Ψ": r"\Psi", "Ω": r"\Omega",
    "△": r"\triangle", "○": r"\bigcirc", "●": r"\bullet", "∘": r"\circ", "ℏ": r"\hbar", "⊙": r"\odot",
    "⊄": r"\nsubseteq", "⊗": r"\otimes", "∀": r"\forall", "∃": r"\exists", "¬": r"\neg", "∽": r"\backsim", "︱": "|",
    "ι": r"\iota", "υ": r"\upsilon", "ϵ": r"\epsilon", "ϕ": r"\phi", "¢": r"\textcent", "ȧ": r"\dot{a}", "┤": r"\dashv", "匸": r"\sqcup",
}
#: Variants of a sign, and letters and ideographs that stand for another.
VARIANTS = {
    "﹦": "＝", "﹢": "＋", "﹣": "－", "︰": "∶", "‒": "−", "‑": "−", "─": "−", "⋅": "·", "∙": "·", "・": "·", "\u0387": "·",
    "º": "°", "˚": "°", "ʹ": "′", "ʺ": "″", "∆": "Δ", "\u2126": "Ω", "∟": "⊥",
}
LETTERS = {"Р": "P", "О": "O", "圧": "压", "変": "变", "況": "况", "虛": "虚", "圏": "圈", "別": "别", "岀": "出", "靜": "静", "帯": "带"}
MATH |= {variant: MATH[sign] for variant, sign in VARIANTS.items()}
#: Small roman numerals and ringed numbers from 11 on are words of a formula.
ROMAN = {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in range(0x2170, 0x217C)}
MATH |= LETTERS | {k: rf"\text{{{v}}}" for k, v in ROMAN.items()} | {chr(0x2460 + i): rf"\text{{\textcircled{{{i + 1}}}}}" for i in range(10, 20)}
#: Italic letters of the mathematical block are plain letters of a formula.
MATH |= {chr(a + i): chr(b + i) for a, b in ((0x1D434, 65), (0x1D44E, 97)) for i in range(26)}
#: Characters that have a meaning of their own in typeset text.
ESCAPES = {"\\": r"\textbackslash{}", "{": r"\{", "}": r"\}", "_": r"\_", "&": r"\&", "%": r"\%", "#": r"\#", "$": r"\$", "^": r"\textasciicircum{}", "~": r"\textasciitilde{}"}
#: In text, dots and numbers in rings have forms of their own; all other signs are one-sign formulas.
PLAIN = {"…": r"$\ldots$", "≤": r"$\leq$", "≥": r"$\geq$", "∽": r"$\sim$", "¢": r"\textcent{}", "﹑": "、", "､": "、", "﹐": "，", "｡": "。"} | LETTERS | ROMAN | {chr(0x2460 + i): rf"\textcircled{{{i + 1}}}" for i in range(10, 20)} | {chr(0x2474 + i): f"（{i + 1}）" for i in range(20)}
_TEXT = str.maketrans(ESCAPES | {k: f"${v}$" for k, v in MATH.items()} | PLAIN | {"\xa0": " ", "\u3000": " ", "\u200b": None})
_PRIVATE = re.compile("[-]")
_WORD_END = re.compile(r"\\[A-Za-z]+$")
_SCRIPT = re.compile(r"^([\^_])\{((?:[^{}]|\{[^{}]*\})*)\}$")
_LAST_SCRIPT = re.compile(r"([\^_])\{((?:[^{}]|\{[^{}]*\})*)\}$")
_FORMULA = re.compile(r"(?<!\\)((?:\\\\)*)\$((?:[^$\\]|\\.)*)\$", re.S)
_NO_TAG = re.compile(r"<(?!!--)(?=[^<>]*(?:<|\Z))")
_INLINE_CLOSE, _DISPLAY_CLOSE = re.compile(r"\\\s*\)"), re.compile(r"\\\s*\]")


def text_to_tex(s: str) -> str:
    """Text outside formulas: special characters escaped, signs as formulas, neighbours merged."""
    return merge_formulas(_PRIVATE.sub("", s).translate(_TEXT))


_LABELS = str.maketrans({k: f"${v}$" for k, v in MATH.items() if not k.isascii()} | {k: v for k, v in PLAIN.items()} | {"\xa0": " ", "\u200b": None})


def patch_labels(s: str) -> str:
    """Text exported from a drawing: signs become commands, its own commands stay."""
    return _PRIVATE.sub("", s).translate(_LABELS)


def math_to_tex(s: str) -> str:
    """Text inside a formula: signs as commands, other scripts as text, specials escaped once."""
    out, word = "", False
    for c in _PRIVATE.sub("", s).replace("\xa0", " ").replace("\u200b", ""):
        new = MATH.get(c)
        if word and c.isascii() and c.isalnum():
            out += " "
        out += c if new is None else new
        word = new is not None and new[-1].isalpha() and new[0] == "\\"
    out = re.sub(r"[^\x00-\x7f]+", lambda m: rf"\text{{{m[0]}}}", out)
    out = re.sub(r"(\\*)([&%#$])", lambda m: m[0] if len(m[1]) % 2 else m[1] + "\\" + m[2], out)
    return out.replace(r"\rm{", r"\mathrm{").replace(r"\bar", r"\overline")


#: What may stand between formulas that become one.
BETWEEN = frozenset(" \t\n=+-<>")


class _Run:
    """Formulas that become one: what is written so far and, apart, the script that ends it."""

    def __init__(self, inner: str):
        self.body, self.kind, self.script = "", "", ""
        self.take("", inner)

    def take(self, gap: str, inner: str) -> bool:
        """Append a formula, and tell whether it could be; a gap before a script or after one and before another ends the run."""
        kind, script = self._whole_script(inner)
        if gap:
            if set(gap) - BETWEEN or self.kind and inner[:1] in ("^", "_"):
                return False
            self._close(gap + inner)
        elif kind and kind == self.kind:  # two scripts of one kind are one group
            self.script = self._spaced(self.script, script)
        elif kind:
            if kind == "^" and not self.kind and "'" in self.body:
                self.body = f"{{{self.body}}}"  # a prime and a power
            elif kind == "^" and "'" in str(self):
                self.body, self.kind, self.script = f"{{{self}}}", "", ""
            self._close("")
            self.kind, self.script = kind, script
        else:
            self._close(inner)
        return True

    @staticmethod
    def _spaced(a: str, b: str) -> str:
        return a + " " + b if b[:1].isalnum() and _WORD_END.search(a) else a + b

    @staticmethod
    def _whole_script(inner: str) -> tuple[str, str]:
        m = _SCRIPT.match(inner)
        return (m[1], m[2]) if m else ("", "")

    def _close(self, more: str) -> None:
        """The script that ended the run is part of what is written; so is what follows, but for its own last script."""
        whole = str(self) if not more else str(self) + more if more[:1] in BETWEEN else self._spaced(str(self), more)
        last = _LAST_SCRIPT.search(whole, max(0, len(whole) - 2000)) if more else None
        self.body, self.kind, self.script = (whole[: last.start()], last[1], last[2]) if last else (whole, "", "")

    def __str__(self) -> str:
        return self.body + (f"{self.kind}{{{self.script}}}" if self.kind else "")


def merge_formulas(s: str) -> str:
    """Formulas with nothing, blanks or operators between them become one.

    A text is a list of gaps and formulas in turn; each formula goes to the run before it or begins one.
    """
    found = [(m.start(2) - 1, m.end(), m[2]) for m in _FORMULA.finditer(s)]
    if len(found) < 2:
        return s
    out, run, done = [], None, 0
    for start, end, inner in found:
        gap = s[done:start]
        if run is None or not run.take(gap, inner):
            out += [f"${run}$", gap] if run else [gap]
            run = _Run(inner)
        done = end
    return "".join([*out, f"${run}$", s[done:]])


def _prepared(fragment: str) -> str:
    """A fragment without comments, and with signs that open no tag as text: the parser would look for their ends again and again."""
    parts, at = [], 0
    while (start := fragment.find("<!--", at)) >= 0:
        parts.append(fragment[at:start])
        end = fragment.find("-->", start + 4)
        at = end + 3 if end >= 0 else len(fragment)
    return _NO_TAG.sub("&lt;", "".join([*parts, fragment[at:]]))


class _Fragment(HTMLParser):
    """Blocks of typeset text; formulas may span tags."""

    INLINE = {"strong": r"\textbf{", "b": r"\textbf{", "u": r"\CJKunderline{"}
    HIDDEN = frozenset(("script", "style", "head", "template"))
    BLOCK = frozenset("p div section article body html h1 h2 h3 h4 h5 h6 ul ol li blockquote pre".split())

    def __init__(self, images: dict[str, str] | None = None):
        super().__init__(convert_charrefs=True)
        self.images, self.blocks, self.out, self.ends = images, [], [], []
        self.formula: list[str] | None = None
        self.display = self.filled = False
        self.depth_var = self.hidden = 0
        self.table: list[list[tuple[str, int, int]]] | None = None
        self.cell: list[str] | None = None
        self.span = (1, 1)

    # -- output ---------------------------------------------------------------------------
    def put(self, s: str) -> None:
        (self.out if self.cell is None else self.cell).append(s)
        self.filled = self.filled or self.cell is None and not s.isspace() and bool(s)

    def flush(self) -> None:
        text = merge_formulas("".join(self.out)).strip()
        if text:
            self.blocks.append(text)
        self.out, self.filled = [], False

    def close_formula(self) -> None:
        inner = "".join(self.formula or [])
        self.formula = None
        self.put(f"\\[{inner}\\]" if self.display else f"${inner}$")

    def math(self, s: str) -> None:
        new = math_to_tex(s)
        if self.formula and new[:1].isalnum() and _WORD_END.search(self.formula[-1]):
            new = " " + new
        self.formula.append(new)

    # -- parser ---------------------------------------------------------------------------
    def handle_data(self, s: str) -> None:
        if self.hidden:
            return
        at = 0
        while at < len(s):
            if self.formula is not None:
                m = (_DISPLAY_CLOSE if self.display else _INLINE_CLOSE).search(s, at)
                self.math(s[at : m.start()] if m else s[at:])
                if not m:
                    return
                self.close_formula()
                at = m.end()
            else:
                m = re.compile(r"\\([(\[])").search(s, at)
                own = s[at : m.start()] if m else s[at:]
                if own:
                    self.put(f"${math_to_tex(own)}$" if self.depth_var and own.strip() else text_to_tex(own))
                if not m:
                    return
                self.formula, self.display, at = [], m[1] == "[", m.end()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = dict(attrs)
        if tag in self.HIDDEN:
            self.hidden += 1
        elif tag == "br":
            if self.cell is None and self.filled and not next((x for x in reversed(self.out) if x), "\n").endswith("\n"):
                self.put("\\\\\n")
        elif tag == "img":
            name = (a.get("src") or "").rpartition("/")[2]
            shown = name if self.images is None else self.images.get(name)
            self.put(rf"\onepicture{{figs/{shown}}}" if shown else "" if self.cell is not None else f"% missing picture {name}\n" if name else "")
        elif tag in ("em", "i", "var"):
            self.depth_var += 1
        elif tag in ("sub", "sup"):
            self.ends.append((tag, self.out if self.cell is None else self.cell, len(self.out if self.cell is None else self.cell)))
        elif tag in self.INLINE:
            self.put(self.INLINE[tag])
        elif tag == "table":
            self.flush()
            self.table = []
        elif tag == "tr" and self.table is not None:
            self.table.append([])
        elif tag in ("td", "th") and self.table is not None:
            if not self.table:
                self.table.append([])
            number = lambda k: int(a[k]) if (a.get(k) or "").isdigit() and int(a[k]) else 1
            self.cell, self.span = [], (number("colspan"), number("rowspan"))
        elif tag in self.BLOCK and self.cell is None:
            self.flush()

    def handle_endtag(self, tag: str) -> None:
        if tag in self.HIDDEN:
            self.hidden = max(0, self.hidden - 1)
        elif tag in ("em", "i", "var"):
            self.depth_var = max(0, self.depth_var - 1)
        elif tag in ("sub", "sup") and self.ends:
            kind, where, at = self.ends.pop()
            inner = "".join(where[at:])
            del where[at:]
            inner = re.sub(r"(?<!\\)\$", "", inner)
            if len(inner) - len(inner.rstrip("\\")) & 1:
                inner = inner[:-1]
            if inner.strip():
                where.append(f"${'_' if kind == 'sub' else '^'}{{{math_to_tex(inner)}}}$")
        elif tag in self.INLINE:
            self.put("}")
        elif tag in ("td", "th") and self.cell is not None:
            text, self.cell = merge_formulas("".join(self.cell)).strip(), None
            self.table[-1].append((text, *self.span))
        elif tag == "table" and self.table is not None:
            grid = expand(self.table)
            self.table = None
            if grid:
                rows = " \\\\\n".join(" & ".join(r) for r in grid)
                self.blocks.append(f"\\begin{{tabular}}{{{'c' * len(grid[0])}}}\n{rows} \\\\\n\\end{{tabular}}")
        elif tag in self.BLOCK and self.cell is None:
            self.flush()

    def finish(self) -> list[str]:
        self.close()
        if self.formula is not None:
            self.close_formula()
        while self.ends:
            self.handle_endtag(self.ends[-1][0])
        if self.table is not None:
            self.handle_endtag("td")
            self.handle_endtag("table")
        self.flush()
        return self.blocks


def expand(rows: list[list[tuple[str, int, int]]]) -> list[list[str]]:
    """Cells (text, columns, rows) as a full grid; a spanning cell's text stands once, blanks fill the rest."""
    grid: dict[tuple[int, int], str] = {}
    width = 0
    for y, cells in enumerate(rows):
        x = 0
        for text, across, down in cells:
            while (y, x) in grid:
                x += 1
            for i in range(down):
                for j in range(across):
                    grid[y + i, x + j] = "" if i or j else text
            x += across
            width = max(width, x)
    return [[grid.get((y, x), "") for x in range(width)] for y in range(len(rows))] if width else []


def blocks(fragment: str | None, images: dict[str, str] | None = None) -> list[str]:
    """Blocks of typeset text of an HTML fragment; ``images`` maps file names, others are marked as missing."""
    if not fragment:
        return []
    p = _Fragment(images)
    p.feed(_prepared(fragment.replace("\r\n", "\n").replace("\r", "\n")))
    return p.finish()


def convert(fragment: str | None) -> str | None:
    """An HTML fragment as typeset text, blocks apart by blank lines."""
    return None if fragment is None else re.sub(r"\\dfrac(?![A-Za-z])", r"\\frac", "\n\n".join(blocks(fragment))).strip()


@F.pandas_udf(T.StringType())
def _convert(texts: pd.Series) -> pd.Series:
    return texts.map(convert, na_action="ignore")


def html_to_tex(text: Column) -> Column:
    """The column form of ``convert``."""
    return _convert(text)


class _Tables(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables, self.rows, self.cell = [], None, None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "table":
            self.rows = []
        elif tag == "tr" and self.rows is not None:
            self.rows.append([])
        elif tag in ("td", "th") and self.rows:
            number = lambda k: int(a[k]) if (a.get(k) or "").isdigit() and int(a[k]) else 1
            self.cell = ["", number("colspan"), number("rowspan")]

    def handle_data(self, s):
        if self.cell is not None:
            self.cell[0] += s

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell is not None and self.rows:
            self.rows[-1].append((self.cell[0].strip(), self.cell[1], self.cell[2]))
            self.cell = None
        elif tag == "table" and self.rows is not None:
            self.tables.append(self.rows)
            self.rows = None


def table_cells(df: DataFrame, id: str, html: str) -> DataFrame:
    """(id, tab, row, col, text, across, down): every cell of every table at its place in the grid."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, text in zip(b["id"], b["html"]):
                p = _Tables()
                p.feed(_prepared(text or ""))
                for t, table in enumerate(p.tables, 1):
                    taken: set[tuple[int, int]] = set()
                    for y, cells in enumerate(table, 1):
                        x = 1
                        for s, across, down in cells:
                            while (y, x) in taken:
                                x += 1
                            taken |= {(y + v, x + u) for v in range(down) for u in range(across)}
                            out.append((i, t, y, x, s, across, down))
                            x += across
            yield pd.DataFrame(out, columns=["id", "tab", "row", "col", "text", "across", "down"])

    kind = df.schema[id].dataType.simpleString()
    return df.select(F.col(id).alias("id"), F.col(html).alias("html")).where("html is not null").mapInPandas(rows, f"id {kind}, tab long, row long, col long, text string, across long, down long").withColumnRenamed("id", id)
