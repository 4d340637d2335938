"""Text functions as column expressions: all run inside the JVM."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

Text = Column | str


def col(x: Text) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_comment(line: Text) -> Column:
    """A line up to its first unescaped percent sign."""
    return F.regexp_replace(col(line), r"(?<!\\)%.*$", "")


def squeeze(x: Text) -> Column:
    """Null as empty text, runs of white space as one blank, no outer blanks."""
    return F.trim(F.regexp_replace(F.coalesce(col(x).cast("string"), F.lit("")), r"[\s 　]+", " "))


def option_letters(x: Text) -> Column:
    """The letters A to I of a text without its tags."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(col(x), F.lit("")), "<[^>]+>", ""), "[^A-I]", "")


def halfwidth_colon(x: Text) -> Column:
    """Full-width colons between digits as half-width ones, chains included."""
    return F.regexp_replace(col(x), r"(?<=\p{Nd})：(?=\p{Nd})", ":")


#: What joins formulas, each group under a rule of its own.
HYPHENS, DASHES = "-", "–—~～"


def chain(joints: str) -> str:
    """The pattern of two or more formulas of one line with one joint between each two."""
    formula = r"\$[^$\n]+\$"
    return f"{formula}(?:[{joints}]{formula})+"


def merge_chains(x: Text, joints: str) -> Column:
    """Every chain of formulas as one formula, its joints and those inside as hyphens; all else stays.

    The text is cut at its chains, so a sign elsewhere, paired or not, changes nothing.
    """
    found = F.regexp_extract_all(col(x), F.lit(chain(joints)), F.lit(0))
    between = F.split(col(x), chain(joints), -1)
    inner = lambda c: F.translate(F.replace(c, F.lit("$"), F.lit("")), joints, "-" * len(joints))
    merged = F.transform(found, lambda c: F.concat(F.lit("$"), inner(c), F.lit("$")))
    return F.array_join(F.transform(F.sequence(F.lit(0), F.size(between) - 1), lambda i: F.concat(F.get(between, i), F.coalesce(F.get(merged, i), F.lit("")))), "")


def merge_hyphens(x: Text) -> Column:
    """``$a$-$b$`` as ``$a-b$``."""
    return merge_chains(x, HYPHENS)


def merge_dashes(x: Text) -> Column:
    """``$a$–$b$`` and its like as ``$a-b$``."""
    return merge_chains(x, DASHES)


def merge_math(x: Text) -> Column:
    """Formulas joined by hyphens, then those joined by dashes or tildes, as one."""
    return merge_dashes(merge_hyphens(x))


def plain_fraction(x: Text) -> Column:
    r"""``\dfrac`` as ``\frac``, the whole command only."""
    return F.regexp_replace(col(x), r"\\dfrac(?![A-Za-z])", r"\\frac")


def drop_private(x: Text) -> Column:
    """A text without private-use characters."""
    return F.regexp_replace(col(x), r"[-]", "")


#: What ends a line.
LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def squeeze_noise(x: Text) -> Column:
    """Lines of three or more capitals alone (scanner noise) go, runs of blank lines become one, none stays outside."""
    kept = F.filter(F.split(col(x), LINE_ENDS), lambda v: ~F.regexp_replace(v, r"^\s+|\s+$", "").rlike("^[A-Z]{3,}$"))
    return F.regexp_replace(F.regexp_replace(F.array_join(kept, "\n"), r"\n{3,}", "\n\n"), r"^\n+|\n+$", "")


def set_text(values: Column, none: str = "（无）") -> Column:
    """The values in order, or a sign that there are none."""
    return F.when(F.size(values) > 0, F.array_join(F.array_sort(values), "、")).otherwise(F.lit(none))


#: Signs of an explanation that only says there is none.
NOTHING = "无沒没有-—–.。、"


def is_placeholder(memo: Text) -> Column:
    """An explanation that is empty or made of such signs alone."""
    return F.translate(squeeze(memo), NOTHING + " ", "") == ""


def answer_bracket(stem: Text, answer: Text) -> Column:
    """A stem whose last empty bracket is the answer command; ``Z`` stands for an answer not known."""
    given = F.coalesce(F.nullif(col(answer), F.lit("")), F.lit("Z"))
    bare = F.regexp_replace(col(stem), r"[（(][\s　\u00a0]*[)）][\s　]*$", "")
    return F.when(F.length(bare) < F.length(col(stem)), F.concat(bare, F.lit("\\xzanswer{"), given, F.lit("}"))).otherwise(col(stem))


#: The picture command for each number of pictures.
PICTURES = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine")


def picture_command(files: Column, label: Text | None = None, align: str | None = None) -> Column:
    """The command that shows the pictures, a line each; vector graphics by their own command.

    One picture has at most an alignment; two to nine have a label each (``label`` and a letter);
    more are shown one by one.
    """
    n = F.size(files)
    shown = F.transform(files, lambda f: F.concat(F.lit("{"), F.when(F.lower(f).endswith(".svg"), F.concat(F.lit("\\includesvg{"), F.substring(f, F.lit(1), F.length(f) - 4), F.lit("}"))).otherwise(f), F.lit("}")))
    single = F.array_join(F.transform(shown, lambda f: F.concat(F.lit(f"\\onepicture{f'[align={align}]' if align else ''}"), f)), "\n")
    base = F.lit("fig") if label is None else col(label)
    letter = lambda i, small: F.char(i + (97 if small else 65))
    labels = F.transform(files, lambda f, i: F.concat(F.lit("label"), letter(i, False), F.lit("="), base, letter(i, True)))
    options = F.array_join(F.concat(labels, F.array(F.lit(f"align={align}"))) if align else labels, ", ")
    name = F.get(F.array(*map(F.lit, PICTURES)), n - 1)
    many = F.concat(F.lit("\\"), name, F.lit("picture["), options, F.lit("]\n"), F.array_join(shown, "\n"))
    return F.when(n.between(2, len(PICTURES)), many).otherwise(single)


def derived_status(questions: Text, placeholder: Text, teacher: Text, student: Text) -> Column:
    """The status of a paper from its facts."""
    return F.when(col(questions) == 0, "未开始").when(col(placeholder) > 0, "待补充").when(~col(student), "进行中").when(~col(teacher), "待复核").otherwise("已完成")


#: Spellings of units in running text and the macro of each, in the order they are taken.
UNIT_FORMS = (
    (r"m\s*/\s*(?:\$?s\s*\^\s*\{?2\}?\$|s(?:\^2|²|2))", r"\\Umsq"),
    (r"(?<![A-Za-z])km\s*/\s*h(?![A-Za-z])", r"\\Ukmh"),
    (r"(?<![A-Za-z\\])m\s*/\s*s(?![A-Za-z0-9$])", r"\\Ums"),
    (r"Ω\s*·\s*m|\\Omega\s*\\cdot\s*m", r"\\UOm"),
)


def unit_macros(x: Text) -> Column:
    """Units written out as unit macros."""
    return reduce(lambda c, s: F.regexp_replace(c, s[0], s[1]), UNIT_FORMS, col(x))


# -- rules -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A rewrite rule: what it finds and what it makes of a text. Register more with ``register``."""

    name: str
    description: str
    finds: str
    rewrite: Callable[[Column], Column]


RULES: list[Rule] = [
    Rule("colon", "full-width colon between digits", r"\p{Nd}+(?:：\p{Nd}+)+", halfwidth_colon),
    Rule("math-hyphen", "formulas joined by a hyphen", chain(HYPHENS), merge_hyphens),
    Rule("math-dash", "formulas joined by a dash or tilde", chain(DASHES), merge_dashes),
    Rule("fraction", "displayed fractions", r"\\dfrac(?![A-Za-z])", plain_fraction),
]


def register(rule: Rule) -> None:
    """Add a rule at the end of the order."""
    if any(r.name == rule.name for r in RULES):
        raise ValueError(f"a rule {rule.name} exists")
    RULES.append(rule)


def fix_text(df: DataFrame, text: str, rules: list[Rule] | None = None) -> DataFrame:
    """``text`` under every rule in order, and ``changes``: the count of each rule that found something.

    A projection a rule, so that each rewrite is computed once for its count and for what follows.
    """
    rules = RULES if rules is None else rules
    names = [f"_changes_{k}" for k in range(len(rules))]
    columns = df.columns
    for name, r in zip(names, rules):
        df = df.select("*", F.regexp_count(text, F.lit(r.finds)).alias(name)).withColumn(text, r.rewrite(F.col(text)))
    counts = [F.struct(F.lit(r.name).alias("rule"), F.col(n).alias("n")) for n, r in zip(names, rules)]
    changes = F.filter(F.array(*counts), lambda c: c["n"] > 0) if counts else F.array().cast("array<struct<rule:string,n:int>>")
    return df.select(*(c for c in columns if c != "changes"), changes.alias("changes"))


def scan_text(df: DataFrame, id: str, text: str, rules: list[Rule] | None = None) -> DataFrame:
    """(id, line, rule, match): every place a rule finds, lines counted from 1."""
    rules = RULES if rules is None else rules
    lines = df.select(id, F.posexplode(F.split(text, r"\r\n|\r|\n")).alias("line", "own"))
    found = F.array(*(F.struct(F.lit(r.name).alias("rule"), F.regexp_extract_all("own", F.lit(r.finds), F.lit(0)).alias("hits")) for r in rules))
    return lines.select(id, (F.col("line") + 1).cast("long").alias("line"), F.explode(found).alias("x")).select(id, "line", "x.rule", F.explode("x.hits").alias("match"))
