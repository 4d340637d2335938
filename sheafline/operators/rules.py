r"""Validation rules: each turns parsed papers into findings (check, level, year, region, number, line, message).

Papers have year, region and text; items add number, typeId, type and block. Rules are plain
projections and filters, so any number of them share one scan of what they read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from sheafline import schema
from sheafline.functions.text import LINE_ENDS, PICTURES as NUMBERS, option_letters, strip_comment
from sheafline.operators.aggregates import outer_items
from sheafline.operators.joins import overlapping
from sheafline.operators.parse import field_names, image_refs, section

CJK = "一-鿿"
CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳"

# -- Fixed values, all that must be as the archive has it -----------------------------------------
#: Commands that a paper no longer uses, environments first, and folders that are called otherwise now.
OLD_ENVIRONMENTS, OLD_COMMANDS, OLD_FOLDERS = ("figure", "subfigure"), ("subref",), ("pic", "tikz")
#: Layout commands that belong to the style, not to a paper.
LAYOUT = ("newpage", "clearpage", "vfill", "vfil", "hfil")
#: Commands that give an answer, and the sentence that stands for a missing explanation.
ANSWERS = ("xzanswer", "tkanswer", "jdanswer")
PLACEHOLDER = "本题原卷及材料中未提供详解"
#: Symbols, prefixes and exponents of units; products of units that are told too.
SYMBOLS = "m s g A V W J N C F H K L O h r Ω Wb Hz Pa mol min rad sr eV Bq Gy Sv lx lm cd".split()
PREFIXES, EXPONENTS = "kMGTPmuncdfh", "^2 ^3 2 3 ² ³".split()
PRODUCTS = "kW·h mA·h μA·h W·h N·m J·s Ω·m O·m".split()
#: Single units with a macro (a suggestion only): unit, power, what may not stand before and behind it.
SUGGESTED = (
    ("m/s", 2, "A-Za-z", "A-Za-z0-9"),
    ("m/s", 0, "A-Za-z", "A-Za-z0-9^"),
    ("km/h", 0, "A-Za-z", "A-Za-z"),
    ("kg/m", 3, "", ""),
    ("mA", 0, "A-Za-z", "A-Za-z"),
    ("kPa", 0, "A-Za-z", "A-Za-z"),
    ("eV", 0, "A-Za-z", "A-Za-z"),
)
#: Formula environments, commands for words inside formulas, and commands that show a picture.
FORMULAS = ("equation", "align", "gather", "multline", "eqnarray")
WORDS = ("text", "mbox", "hbox")
GRAPHICS = ("includegraphics", "includesvg")
PICTURES = (*GRAPHICS, *(f"{n}picture" for n in NUMBERS))
#: Signs before a circled number that name a figure or an option, those after one that ends a formula, and those before one that is referred to.
FIGURE_WORDS, AFTER_FORMULA, REFERRING = "图象选项为示是", "，。；、,;:.）) \n", "由、和及联"
#: Words that refer to a figure.
FIGURE_MENTION = r"如图|图[0-9０-９一二三四五六甲乙丙丁所中示]|见图"
LABEL = r"^(?:19|20)[0-9]{2}.+[0-9]{2}[a-z]?$"


# -- patterns, made of them -----------------------------------------------------------------------
def any_of(values: Iterable[str]) -> str:
    """A pattern for any of several texts, longer ones first."""
    return "(?:" + "|".join(re.escape(v) for v in sorted(values, key=len, reverse=True)) + ")"


def command(names: Iterable[str]) -> str:
    """A pattern for whole commands."""
    return rf"\\{any_of(names)}(?![A-Za-z])"


def unit_pattern() -> str:
    """A quotient of two units, or one of the products, that no letter or backslash touches."""
    unit = rf"[{PREFIXES}]?{any_of(SYMBOLS)}{any_of(EXPONENTS)}?"
    products = "|".join(r"(?:·|\\cdot\s*)".join(map(re.escape, p.split("·"))) for p in PRODUCTS)
    return rf"(?<![\\A-Za-z])(?:{unit}\s*/\s*{unit}|{products})(?![A-Za-z])"


def suggested_pattern(unit: str, power: int, before: str, behind: str) -> str:
    """One unit of the suggestions, with blanks around its bar and its power in any spelling."""
    body = r"\s*/\s*".join(map(re.escape, unit.split("/"))) + (rf"\s*[\^{'²³'[power - 2]}]?{power}" if power else "")
    return (f"(?<![{before}])" if before else "") + body + (f"(?![{behind}])" if behind else "")


def without_words(formula: Column) -> Column:
    return F.regexp_replace(formula, rf"\\{any_of(WORDS)}\{{[^{{}}]*\}}", "")


def inline_formulas(line: Column) -> Column:
    """The closed formulas of a line: a line is cut at its dollar signs, every second piece is one."""
    parts = F.split(F.regexp_replace(line, r"\$+", r"\$"), r"\$", -1)
    return F.filter(parts, lambda x, i: (i % 2 == 1) & (i < F.size(parts) - 1))


def formula_blocks(text: Column) -> Column:
    """What stands inside the formula environments of a text."""

    def inside(name: str) -> Column:
        after = F.split(text, rf"\\begin\{{{name}\*?\}}", -1)
        cut = F.transform(F.slice(after, 2, F.greatest(F.size(after), F.lit(1))), lambda x: F.split(x, rf"\\end\{{{name}\*?\}}", 2))
        return F.transform(F.filter(cut, lambda x: F.size(x) > 1), lambda x: x[0])

    return F.flatten(F.array(*map(inside, FORMULAS)))


def finding(check: str, level: str, message: Column, number: Column | None = None, line: Column | None = None) -> Column:
    none = F.lit(None).cast("long")
    return F.struct(F.lit(check).alias("check"), F.lit(level).alias("level"), (number if number is not None else none).cast("long").alias("number"), (line if line is not None else none).cast("long").alias("line"), message.alias("message"))


def emit(df: DataFrame, *found: Column, lists: tuple[Column, ...] = ()) -> DataFrame:
    """(check, level, year, region, number, line, message): the given findings that are not null, and
    those of the given arrays. One scan, however many rules are asked."""
    all_ = F.flatten(F.array(F.array_compact(F.array(*found)), *lists)) if found else F.flatten(F.array(*lists))
    rows = df.select("year", "region", F.explode(all_).alias("f"))
    return rows.select("f.check", "f.level", "year", "region", "f.number", "f.line", "f.message")


class Rules(NamedTuple):
    """Rules of one grain: findings that are null or not, and arrays of findings. Rules of a grain add up to one scan."""

    found: tuple[Column, ...] = ()
    lists: tuple[Column, ...] = ()

    def plus(self, *more: "Rules") -> "Rules":
        return Rules(sum((r.found for r in more), self.found), sum((r.lists for r in more), self.lists))

    def on(self, df: DataFrame) -> DataFrame:
        return emit(df, *self.found, lists=self.lists)

    def where(self, condition: Column) -> "Rules":
        """The same rules for the rows that meet a condition."""
        sure = F.coalesce(condition, F.lit(False))
        return Rules(tuple(F.when(sure, c) for c in self.found), tuple(F.when(sure, c).otherwise(F.array()) for c in self.lists))


def each(values: Column, check: str, level: str, number: str | None = None, line: str | None = None) -> Column:
    """A finding for every value of an array, as an array."""
    made = F.transform(values, lambda v: finding(check, level, v, F.col(number) if number else None, F.col(line) if line else None))
    return F.coalesce(made, F.array())


def skeleton_rules(document_class: str, version: str) -> Rules:
    """What a paper must and must not hold.

    ``document_class`` and ``version`` are the exact names of the archive's class and of the command that switches versions.
    """
    t = F.col("text")
    parts = {
        "class": t.rlike(rf"\\documentclass(?:\[[^\]]*\])?\{{{re.escape(document_class)}\}}"),
        "version switch": t.contains(f"\\{version}"),
        "begin": t.contains("\\begin{document}"),
        "end": t.contains("\\end{document}"),
        "chapter": t.contains("\\chapter{"),
    }
    old = {n: t.contains(f"\\begin{{{n}}}") for n in OLD_ENVIRONMENTS} | {n: t.contains(f"\\{n}") for n in OLD_COMMANDS} | {f"{n}/": t.rlike(rf"(?<![A-Za-z0-9_/]){n}/") for n in OLD_FOLDERS}
    has = t.rlike(r"(?m)^%%\s*number\s*[:：]")
    given = t.rlike(rf"\\{any_of(ANSWERS)}")
    held = F.regexp_count(t, F.lit(PLACEHOLDER))
    return Rules(
        (
            *(F.when(~there, finding("skeleton", "error", F.lit(f"missing {n}"))) for n, there in parts.items()),
            *(F.when(there, finding("legacy", "error", F.lit(n))) for n, there in old.items()),
            F.when(~has, finding("items", "error", F.lit("no item"))),
            F.when(has & ~given, finding("answers", "error", F.lit("no answer command"))),
            F.when(held > 0, finding("placeholder", "warning", held.cast("string"))),
        )
    )


def skeleton(papers: DataFrame, document_class: str, version: str) -> DataFrame:
    return skeleton_rules(document_class, version).on(papers)


def field_rules() -> Rules:
    """Order of fields, explanations, images shown twice."""
    b, n = F.col("block"), F.col("number")
    order = field_names(b) != F.array(*map(F.lit, schema.FIELDS))
    basic, author = b.rlike(r"\\memoanswer\s*\{"), b.rlike(r"\\memoanswer\s*\[")
    images = F.regexp_extract_all(b, F.lit(r"(?:figs|TikZ)/[A-Za-z0-9_\-]+"), F.lit(0))
    twice = F.filter(F.array_distinct(images), lambda x: F.size(F.filter(images, lambda y: y == x)) > 1)
    return Rules(
        (
            F.when(order, finding("fields", "error", F.array_join(field_names(b), ","), n)),
            F.when(~basic & author, finding("explanation", "error", F.lit("author's only"), n)).when(~basic, finding("explanation", "error", F.lit("none"), n)),
            F.when(F.size(twice) > 0, finding("images", "warning", F.array_join(F.array_sort(twice), ","), n)),
        )
    )


def item_fields(items: DataFrame) -> DataFrame:
    return field_rules().on(items)


def labels(text: Column) -> Column:
    """Labels defined in a text, by picture options and by ``\\label``, repeats included."""
    picture = F.regexp_extract_all(text, F.lit(r"(?<![A-Za-z])label[A-I]?=([^\s,}\]]+)"), F.lit(1))
    return F.concat(picture, F.regexp_extract_all(text, F.lit(r"\\label\{([^}]+)\}"), F.lit(1)))


def refs(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"\\ref\{([^}]+)\}"), F.lit(1)))


def reference_rules() -> Rules:
    """Form of labels, references without a label, single pictures without number, repeats."""
    own = labels(F.col("text"))
    bad = F.filter(F.array_distinct(own), lambda x: ~x.rlike(LABEL))
    dangling = F.array_except(refs(F.col("text")), own)
    repeated = F.filter(F.array_distinct(own), lambda x: F.size(F.filter(own, lambda y: y == x)) > 1)
    singles = F.regexp_extract_all("text", F.lit(r"\\onepicture\s*\[([^\]]*)\]"), F.lit(1))
    bare = F.filter(singles, lambda o: o.rlike(r"(?<![A-Za-z])label[A-I]?=") & ~o.rlike(r"(?<![A-Za-z])(?:num|fig|fignum)[A-I]?="))
    return Rules(lists=(each(bad, "label", "error"), each(dangling, "ref", "error"), each(repeated, "label-twice", "error"), each(bare, "label-number", "warning")))


def label_rules(papers: DataFrame) -> DataFrame:
    return reference_rules().on(papers)


def text_rules() -> Rules:
    """R12 to R17 on lines (year, region, line, value); every picture of a line is looked at."""
    v = strip_comment(F.col("value"))
    han, at = f"[{CJK}]", F.col("line")
    # pieces with an odd number of dollar signs before them are inside a formula, closed or not
    inside = F.filter(F.split(v, r"\$", -1), lambda x, i: i % 2 == 1)
    shown = F.flatten(F.transform(inside, lambda x: F.regexp_extract_all(x, F.lit(command(GRAPHICS)), F.lit(0))))
    found = {
        ("unit", "error"): F.regexp_extract_all(v, F.lit(unit_pattern()), F.lit(0)),
        ("layout", "error"): F.transform(F.regexp_extract_all(v, F.lit(command(LAYOUT)), F.lit(0)), lambda x: F.substring(x, 2, 20)),
        ("math-picture", "error"): F.transform(shown, lambda _: F.lit("picture inside a formula")),
        ("math-cjk", "error"): F.transform(F.filter(inline_formulas(v), lambda m: without_words(m).rlike(han)), lambda m: F.concat(F.lit("$"), m, F.lit("$"))),
        ("roman-cjk", "error"): F.filter(F.regexp_extract_all(v, F.lit(r"\\mathrm\{[^{}]*\}"), F.lit(0)), lambda m: m.rlike(han)),
    }
    close = v.rlike(f"{han}[A-Za-z]") | v.rlike(f"[A-Za-z]{han}")
    return Rules(
        (
            F.when(v.rlike(f"{han}[,;:()]{han}"), finding("punctuation", "warning", F.lit("half-width"), line=at)),
            F.when(~v.contains("$") & close, finding("spacing", "warning", F.lit("no blank"), line=at)),
        ),
        tuple(each(values, *kind, line="line") for kind, values in found.items()),
    )


def line_rules(own: DataFrame) -> DataFrame:
    return text_rules().on(own)


def with_previous(own: DataFrame) -> DataFrame:
    """Lines with ``prev``, the line before without its comment."""
    return own.withColumn("prev", F.rtrim(strip_comment(F.lag("value").over(Window.partitionBy("year", "region").orderBy("line")))))


def break_rules() -> Rules:
    """R15 on lines with the one before: a bold entry right after a line of prose."""
    p = F.ltrim("prev")
    prose = p.rlike(f"[{CJK}]") & ~p.rlike(r"(?:\\par|\\\\)$") & ~(p.startswith("\\") & ~p.startswith("\\textbf"))
    bold = F.ltrim("value").startswith("\\textbf{")
    return Rules((F.when(bold & prose, finding("paragraph", "warning", F.substring(F.trim("value"), 1, 20), line=F.col("line"))),))


def paragraph_breaks(own: DataFrame) -> DataFrame:
    return break_rules().on(with_previous(own))


def block_rules() -> Rules:
    """R13 and R14 on formula environments."""
    blocks = formula_blocks(F.col("text"))
    shown = F.transform(F.filter(blocks, lambda m: m.rlike(command(GRAPHICS))), lambda _: F.lit("picture in an environment"))
    words = F.transform(F.filter(blocks, lambda m: without_words(m).rlike(f"[{CJK}]")), lambda _: F.lit("in an environment"))
    return Rules(lists=(each(shown, "math-picture", "error"), each(words, "math-cjk", "error")))


def math_blocks(papers: DataFrame) -> DataFrame:
    return block_rules().on(papers)


def unknown_macros(papers: DataFrame, dictionary: DataFrame, macro: str = "macro") -> DataFrame:
    r"""Unit macros used outside comments and not in the dictionary, which is of a fixed size."""
    bare = F.array_join(F.transform(F.split("text", LINE_ENDS), strip_comment), "\n")
    used = papers.select("year", "region", F.explode(F.array_distinct(F.regexp_extract_all(bare, F.lit(r"\\(U[A-Za-z]+)"), F.lit(1)))).alias("name"))
    known = dictionary.select(F.regexp_replace(macro, r"^\\", "").alias("name")).distinct()
    return emit(used.join(F.broadcast(known), "name", "left_anti"), finding("macro", "error", F.col("name")))


def unit_rules() -> Rules:
    """Single units that have a macro (to be asked for)."""
    found = F.flatten(F.array(*(F.regexp_extract_all(strip_comment(F.col("value")), F.lit(suggested_pattern(*u)), F.lit(0)) for u in SUGGESTED)))
    return Rules(lists=(each(found, "unit-suggestion", "warning", line="line"),))


def suggested_units(own: DataFrame) -> DataFrame:
    return unit_rules().on(own)


def reply_rules() -> Rules:
    r"""R23, R24 on items without options: answer commands, and sub-questions against answers."""
    b, n = F.col("block"), F.col("number")
    body = F.when(F.locate("%% answer:", b) > 0, section(b, "%% body:", "%% answer:")).otherwise(b)
    answer = section(b, "%% answer:", "%% memo")
    asked, long, short = outer_items(body), answer.contains("\\jdanswer"), b.contains("\\tkanswer")
    given = outer_items(F.regexp_extract(answer, r"(?s)\\jdanswer\*?\s*\{(.*?)\n\}", 1))
    one = F.regexp_count(body, F.lit(r"\\begin\{enumerate\}")) == 1
    no = ~long & ~short
    found = (
        F.when(no, finding("answer", "error", F.lit("none"), n)),
        F.when(~no & (asked >= 2) & ~long, finding("answer", "error", F.lit("no long answer"), n)),
        F.when(long & (F.coalesce("typeId", F.lit(0)) != 4) & one & (asked > 0) & (given > 0) & (asked != given), finding("answer-count", "warning", F.concat_ws("/", asked.cast("string"), given.cast("string")), n)),
    )
    return Rules(found).where(~F.coalesce(F.col("typeId").isin(*schema.CHOICE_IDS), F.lit(False)))


def answer_rules(items: DataFrame) -> DataFrame:
    return reply_rules().on(items)


def mention_rules() -> Rules:
    """Explanations that mention a figure where there is none."""
    b, n = F.col("block"), F.col("number")
    memo = F.when(F.locate("%% memo", b) > 0, F.substring(b, F.locate("%% memo", b), F.length(b))).otherwise(b)
    told = b.contains("\\memoanswer")
    return Rules((F.when(told & b.rlike(FIGURE_MENTION) & ~b.rlike(command(PICTURES)), finding("figure", "error", F.lit("item has none"), n)), F.when(told & memo.rlike(FIGURE_MENTION) & ~memo.rlike(command(PICTURES)), finding("figure", "warning", F.lit("explanation has none"), n))))


def figure_rules(items: DataFrame) -> DataFrame:
    return mention_rules().on(items)


def answer_sites(block: Column) -> Column:
    """The answers a choice item gives at its three sites, those that are there."""
    sites = (option_letters(F.regexp_extract(block, r"\\xzanswer\{([^}]*)\}", 1)), F.regexp_extract(block, r"\\[a-z]+choices?\s*\[[^\]]*answer=([A-I]+)", 1), F.regexp_extract(block, r"%%\s*answer:\s*([A-I]+)", 1))
    return F.array_distinct(F.filter(F.array(*sites), lambda x: x != ""))


def is_choice() -> Column:
    return reduce(lambda a, k: a | F.coalesce(F.col("type"), F.lit("")).contains(k), schema.CHOICE_NAMES, F.lit(False))


def site_rules() -> Rules:
    """The sites of a choice item's answer disagree."""
    sites = answer_sites(F.col("block"))
    return Rules((F.when(F.size(sites) > 1, finding("answer-sites", "error", F.array_join(sites, ","), F.col("number"))),)).where(is_choice())


def choice_rules(items: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """The sites of an answer disagree, or none is in the set that the archive has for the number."""
    out = site_rules().on(items)
    if answers is None:
        return out
    rows = items.where(is_choice()).withColumn("sites", answer_sites(F.col("block")))
    sets = answers.groupBy("year", "region", "number").agg(F.array_sort(F.collect_set("answer")).alias("allowed"))
    apart = rows.join(sets, ["year", "region", "number"]).where((F.size("sites") > 0) & ~F.arrays_overlap("sites", "allowed"))
    return out.unionByName(emit(apart, finding("answer-set", "error", F.array_join("allowed", ","), F.col("number"))))


def formula_signs(memo: Column) -> Column:
    """(c, refers) of the circled numbers of an explanation that number formulas, in order.

    A number counts if its run of circled numbers is followed by 式, or stands alone in braces; else
    by the sign after it, unless the one right before it names a figure or an option. Stages,
    figures and labels of sub-items do not count. ``refers`` tells those that are referred to.
    """
    own = F.split(memo, "")
    n = F.size(own)
    within = lambda signs, c: F.coalesce(F.contains(F.lit(signs), c) & (c != ""), F.lit(False))
    places = F.filter(F.sequence(F.lit(0), n - 1), lambda i: within(CIRCLED, F.get(own, i)))
    marks = F.transform(places, lambda i: F.struct(F.get(own, i).alias("c"), F.get(own, i - 1).alias("before"), F.coalesce(F.get(own, i + 1), F.lit("")).alias("after"), F.substring(memo, i + 2, n).alias("rest"), F.substring(memo, F.lit(1), i).alias("head")))

    def counts(m: Column) -> Column:
        tagged = m["head"].rlike(r"\{[ \t\n]*$") & (m["after"] == "}")
        return m["rest"].rlike(rf"^[{CIRCLED}]*式") | ~within(FIGURE_WORDS, m["before"]) & (tagged | (m["after"] == "") | within(AFTER_FORMULA, m["after"]))

    return F.transform(F.filter(marks, counts), lambda m: F.struct(m["c"].alias("c"), (within(REFERRING, m["before"]) | (m["after"] == "式")).alias("refers")))


def formula_numbers(memo: Column) -> Column:
    """The distinct numbers of ``formula_signs`` in ascending order."""
    return F.array_sort(F.array_distinct(F.transform(formula_signs(memo), lambda m: F.instr(F.lit(CIRCLED), m["c"]))))


def with_signs(items: DataFrame, memo: str = "memo") -> DataFrame:
    """Items with the ``signs`` of formulas in their explanations and the numbers ``present``."""
    return items.withColumn("signs", formula_signs(F.col(memo))).withColumn("present", formula_numbers(F.col(memo)))


def order_rules() -> Rules:
    """R30, R31 on items with signs: numbers missing below the largest, and numbers that stand once, as a reference."""
    absent = F.when(F.size("present") > 0, F.array_except(F.sequence(F.lit(1), F.array_max("present")), "present")).otherwise(F.array().cast("array<int>"))
    of = lambda i: F.filter("signs", lambda m: m["c"] == F.substring(F.lit(CIRCLED), i, F.lit(1)))
    once = F.filter("present", lambda i: (F.size(of(i)) == 1) & F.get(of(i), F.lit(0))["refers"])
    text = lambda x: F.transform(x, lambda i: i.cast("string"))
    return Rules(lists=(each(text(absent), "formula-gap", "error", number="number"), each(text(once), "formula-once", "warning", number="number"))).where(F.col("present").isNotNull())


def numbering_rules(items: DataFrame, memo: str = "memo") -> DataFrame:
    return order_rules().on(with_signs(items, memo))


def check_papers(papers: DataFrame, items: DataFrame, own: DataFrame, dictionary: DataFrame, document_class: str, version: str) -> DataFrame:
    """All rules on papers, their items and their lines: one scan of each, and one for the macros."""
    parts = (
        skeleton_rules(document_class, version).plus(reference_rules(), block_rules()).on(papers),
        unknown_macros(papers, dictionary),
        field_rules().plus(reply_rules(), mention_rules(), site_rules(), order_rules()).on(with_signs(items)),
        text_rules().plus(unit_rules(), break_rules()).on(with_previous(own)),
    )
    return reduce(DataFrame.unionByName, parts)


def vocabulary(df: DataFrame, field: str, allowed: tuple[str, ...], check: str, number: str | None = None) -> DataFrame:
    """Values outside a fixed vocabulary, nulls and blanks included."""
    bad = ~F.coalesce(F.col(field), F.lit("")).isin(*allowed)
    return emit(df.where(bad), finding(check, "error", F.coalesce(F.col(field), F.lit("")), F.col(number) if number else None))


def boxes(df: DataFrame) -> DataFrame:
    """Boxes (x0, y0, x1, y1) of a recipe outside their picture (w, h) or without area."""
    inside = (F.col("x0") >= 0) & (F.col("y0") >= 0) & (F.col("x1") <= F.col("w")) & (F.col("y1") <= F.col("h")) & (F.col("x0") < F.col("x1")) & (F.col("y0") < F.col("y1"))
    return emit(df.where(~F.coalesce(inside, F.lit(False))), finding("box", "error", F.concat_ws(",", "x0", "y0", "x1", "y1")))


def recipes(crops: DataFrame, pictures: DataFrame, used: DataFrame) -> DataFrame:
    """Invalid crops, boxes outside their picture, unknown sources or targets, targets of another size
    (with trimming, of a larger one), targets given twice, crops that overlap, pictures that nothing uses.

    ``crops`` has year, region, source, pos, x0, y0, x1, y1, target, trims, valid; ``pictures`` has year,
    region, path, w, h, format (that of its bytes); ``used`` has year, region, path.
    """
    key = ["year", "region"]
    of = lambda name: pictures.select(*key, F.col("path").alias(name), F.col("w").alias(f"{name}_w"), F.col("h").alias(f"{name}_h"), F.col("format").alias(f"{name}_f"))
    rows = crops.join(of("source"), [*key, "source"], "left").join(of("target"), [*key, "target"], "left")
    ok = F.col("valid") & F.col("source_w").isNotNull()
    inside = (F.col("x0") >= 0) & (F.col("y0") >= 0) & (F.col("x1") <= F.col("source_w")) & (F.col("y1") <= F.col("source_h")) & (F.col("x0") < F.col("x1")) & (F.col("y0") < F.col("y1"))
    w, h, tw, th = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.col("target_w"), F.col("target_h")
    size = F.when(F.col("trims"), (tw > w) | (th > h)).otherwise((tw != w) | (th != h))
    ends = F.lower(F.regexp_extract("target", r"\.([^.]*)$", 1))
    out = emit(
        rows,
        F.when(~F.col("valid"), finding("recipe", "error", F.coalesce("target", F.lit("")))),
        F.when(F.col("valid") & F.col("source_w").isNull(), finding("recipe-source", "error", F.coalesce("source", F.lit("")))),
        F.when(F.col("valid") & tw.isNull(), finding("recipe-target", "error", F.coalesce("target", F.lit("")))),
        F.when(ok & ~inside, finding("recipe-box", "error", F.concat_ws(",", "x0", "y0", "x1", "y1"))),
        F.when(ok & inside & size, finding("recipe-size", "error", F.col("target"))),
        F.when(tw.isNotNull() & (F.replace(ends, F.lit("jpeg"), F.lit("jpg")) != F.col("target_f")), finding("recipe-format", "error", F.col("target"))),
    )
    twice = emit(crops.where("target is not null").groupBy(*key, "target").count().where("count > 1"), finding("recipe-twice", "error", F.col("target")))
    pairs = overlapping(crops.where("valid").withColumn("id", F.col("pos").cast("long")), [*key, "source"], "id")
    orphan = pictures.select(*key, "path").join(crops.select(*key, F.col("target").alias("path")), [*key, "path"], "left_anti").join(crops.select(*key, F.col("source").alias("path")), [*key, "path"], "left_anti").join(used, [*key, "path"], "left_anti")
    return out.unionByName(twice).unionByName(emit(pairs, finding("recipe-overlap", "warning", F.concat_ws("/", "source", "a", "b")))).unionByName(emit(orphan, finding("recipe-orphan", "warning", F.col("path"))))


def registry(entries: DataFrame, used: DataFrame, sources: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Redraw registry: entries given twice or with an absolute path, references not registered,
    entries not used, sources neither registered nor used. A null original is a declared none.

    ``entries`` has year, region, tikz, original; ``used`` and ``sources`` have year, region, tikz.
    With ``files`` (year, region, path) also: originals that are no file, registered or used drawings
    without a source, and papers that use drawings and register none.
    """
    key = ["year", "region", "tikz"]
    listed, needed, there = entries.select(*key).distinct(), used.select(*key).distinct(), sources.select(*key).distinct()
    name = F.col("tikz")
    parts = [
        emit(entries.groupBy(*key).count().where("count > 1"), finding("registry-twice", "error", name)),
        emit(entries.where(F.col("original").startswith("/")), finding("registry-path", "error", F.col("original"))),
        emit(needed.join(listed, key, "left_anti"), finding("unregistered", "error", name)),
        emit(listed.join(needed, key, "left_anti"), finding("unused", "warning", name)),
        emit(there.join(listed, key, "left_anti").join(needed, key, "left_anti"), finding("orphan", "warning", name)),
    ]
    if files is not None:
        own = files.select("year", "region", F.col("path").alias("original")).distinct()
        gone = entries.where("original is not null").join(own, ["year", "region", "original"], "left_anti")
        bare = needed.select("year", "region").distinct().join(listed.select("year", "region").distinct(), ["year", "region"], "left_anti")
        parts += [
            emit(gone, finding("registry-original", "error", F.col("original"))),
            emit(listed.unionByName(needed).distinct().join(there, key, "left_anti"), finding("registry-source", "error", name)),
            emit(bare, finding("registry-missing", "error", F.lit("no registry"))),
        ]
    return reduce(DataFrame.unionByName, parts)


def source_numbers(items: DataFrame, numbers: DataFrame) -> DataFrame:
    """Items whose number lies outside the paper's list of source numbers, source numbers given twice, and
    lists as long as another number of items.

    ``items`` has year, region, number; ``numbers`` has year, region and sourceNumbers, an array.
    """
    both = items.join(numbers.select("year", "region", "sourceNumbers"), ["year", "region"])
    outside = emit(both.where((F.col("number") < 1) | (F.col("number") > F.size("sourceNumbers"))), finding("source-number", "error", F.lit("outside the list"), F.col("number")))
    each_ = numbers.select("year", "region", F.explode("sourceNumbers").alias("n")).groupBy("year", "region", "n").count().where("count > 1")
    twice = emit(each_, finding("source-twice", "error", F.col("n").cast("string")))
    counted = items.groupBy("year", "region").agg(F.count_distinct("number").alias("own")).join(numbers, ["year", "region"]).where("own <> size(sourceNumbers)")
    return outside.unionByName(twice).unionByName(emit(counted, finding("source-length", "warning", F.concat_ws("/", F.col("own").cast("string"), F.size("sourceNumbers").cast("string")))))


def material(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Elements of a material missing or empty, and outputs made of another source.

    ``expected`` has year, region, element; ``actual`` adds length, stored_hash and hash.
    """
    both = expected.join(actual, ["year", "region", "element"], "left")
    gone = F.coalesce("length", F.lit(0)) == 0
    return emit(both, F.when(gone, finding("material", "error", F.col("element"))), F.when(~gone & (F.col("stored_hash") != F.col("hash")), finding("drift", "error", F.col("element"))))


def work_filter(df: DataFrame, years: list[str] | None = None, region: str | None = None, keyword: str | None = None) -> DataFrame:
    """Rows of some years, with a part of the region's name, and a keyword in the path or its target."""
    if years:
        df = df.where(F.col("year").isin(*years))
    if region:
        df = df.where(F.col("region").contains(region))
    return df.where(F.col("path").contains(keyword) | F.coalesce(F.col("target").contains(keyword), F.lit(False))) if keyword else df


def stale_commands(own: DataFrame) -> DataFrame:
    """Lines of documents that still tell to change into a folder, unless they say not to."""
    bad = F.col("value").rlike(r"(?:^|[`\s])cd\s+[\w./-]+") & ~F.col("value").rlike(r"不|无需|勿|避免|not |never ")
    return emit(own.where(bad), finding("stale", "error", F.trim("value"), line=F.col("line")))
