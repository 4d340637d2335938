r"""Parsing of paper sources into items, sections, paragraphs, options and references.

A paper source is a text whose items begin at comment lines ``%% number: n`` and whose other fields
follow in lines ``%% name: value``; the sections body, answer and memo follow their own marks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

#: How an item begins, leniently and strictly.
ITEM_START = r"(?m)(?=^%%\s*number\s*[:：])"
STRICT_START = r"(?m)(?=^%% number:)"


def item_blocks(df: DataFrame, id: str, text: str = "text", strict: bool = False) -> DataFrame:
    """(id, pos, number, block): item blocks; what precedes the first and blocks without digits go."""
    blocks = df.select(id, F.posexplode(F.split(text, STRICT_START if strict else ITEM_START)).alias("pos", "block"))
    number = F.regexp_extract("block", r"^%%\s*number\s*[:：]\s*([0-9]+)", 1)
    return blocks.where(number != "").select(id, "pos", number.cast("long").alias("number"), "block")


def line_blocks(own: DataFrame, id: str, start: str = r"^%%\s*number\s*[:：]") -> DataFrame:
    """Lines (id, line, value) with ``block``: how many starts stand up to a line."""
    from pyspark.sql import Window

    w = Window.partitionBy(id).orderBy("line")
    return own.withColumn("block", F.sum(F.col("value").rlike(start).cast("int")).over(w)).where("block > 0")


def metadata(block: Column) -> Column:
    """Fields of a block as a map; of a field given twice the last value counts."""
    line = r"(?m)^%%[ \t]*([A-Za-z]+)[ \t]*[:：][ \t]*(.*)$"
    keys, values = (F.regexp_extract_all(block, F.lit(line), F.lit(i)) for i in (1, 2))
    pairs = F.arrays_zip(keys.alias("k"), values.alias("v"))
    names = F.array_distinct(keys)
    return F.map_from_arrays(names, F.transform(names, lambda n: F.trim(F.element_at(F.filter(pairs, lambda p: p["k"] == n), -1)["v"])))


def field_names(block: Column) -> Column:
    """The names of a block's fields, in order."""
    return F.regexp_extract_all(block, F.lit(r"(?m)^%%\s*([A-Za-z]+)\s*[:：]"), F.lit(1))


def section(block: Column, start: str, end: str | None) -> Column:
    """What stands between the line of one mark and the next mark; empty where the first is missing."""
    at = F.locate(start, block)
    rest = F.substring(block, at + len(start), F.length(block))
    rest = F.when(F.locate("\n", rest) > 0, F.substring(rest, F.locate("\n", rest) + 1, F.length(rest))).otherwise(F.lit(""))
    cut = rest if end is None else F.when(F.locate(end, rest) > 0, F.substring(rest, F.lit(1), F.locate(end, rest) - 1)).otherwise(rest)
    return F.when(at > 0, F.regexp_replace(cut, r"^\s+|\s+$", "")).otherwise(F.lit(""))


def parse_papers(df: DataFrame, id: str, text: str = "text") -> DataFrame:
    """(id, pos, number, meta, body, answer, memo) of every item of every paper source."""
    b = F.col("block")
    return item_blocks(df, id, text).select(id, "pos", "number", metadata(b).alias("meta"), section(b, "%% body:", "%% answer:").alias("body"), section(b, "%% answer:", "%% memo:").alias("answer"), section(b, "%% memo:", None).alias("memo"))


def collect_papers(items: DataFrame, id: str) -> DataFrame:
    """(id, chapter, items): one nested row per paper, items in order: the archive form."""
    each = F.struct("pos", "number", "meta", "body", "answer", "memo")
    return items.groupBy(id).agg(F.first(F.col("meta")["chapter"], True).alias("chapter"), F.array_sort(F.collect_list(each), lambda a, b: (a["pos"] - b["pos"]).cast("int")).alias("items"))


def source_numbers(text: Column) -> Column:
    """The paper's list of source numbers."""
    tag = F.regexp_extract(text, r"(?m)^%%[ \t]*sourceNumbers[ \t]*[:：][ \t]*(.*)$", 1)
    return F.transform(F.regexp_extract_all(tag, F.lit(r"[0-9]+"), F.lit(0)), lambda x: x.cast("long"))


def paragraphs(html: Column) -> Column:
    """Paragraphs of a fragment, cut at ends of paragraphs and line breaks; blank ones go."""
    parts = F.transform(F.split(html, r"(?i)</p\s*>|<br\s*/?>"), lambda x: F.regexp_replace(x, r"(?i)<p(?:\s[^>]*)?>", ""))
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: F.trim(F.regexp_replace(x, r"<[^>]*>|&nbsp;", "")) != "")


#: Fixed value: an option label and what must stand before it.
OPTION = r"(?:^|(?<=[\s　。？?；;]))(?:[（(]([A-I])[）)]|([A-I])[．.、])\s*"


def options(text: Column) -> Column:
    """Options of a text as (label, value), in order; empty where it has none."""
    marks = F.regexp_extract_all(text, F.lit(OPTION), F.lit(0))
    labels = F.transform(marks, lambda m: F.regexp_extract(m, "[A-I]", 0))
    values = F.slice(F.split(text, OPTION), 2, F.greatest(F.size(marks), F.lit(1)))
    return F.when(F.size(marks) > 0, F.arrays_zip(labels.alias("label"), F.transform(values, lambda v: F.trim(v)).alias("value"))).otherwise(F.array().cast("array<struct<label:string,value:string>>"))


_MARK = re.compile(r"（([A-I])）|(?<![A-Za-z0-9])([A-I])[．.、][ \t]")
_FIRST = re.compile(r"（([A-I])）|([A-I])[．.、]")
_LONE = re.compile(r"[（(]?[A-I][）)、．.]?")
_ASKED = re.compile(r"[（(]?\s*\d+\s*[）)、．.]")
_PICTURE = re.compile(r"<img\b[^>]*>|!\[[^\]]*\]\([^)]*\)")


def paragraph_options(text: str) -> list[tuple[str, str]]:
    """(letter, content) of all options of a paragraph: at a label in brackets, or a letter with its
    sign and a blank; the paragraph's first label needs no blank. What stands before a label is none."""
    text = text.strip()
    cuts = sorted({m.start() for m in _MARK.finditer(text)} | {0})
    out = []
    for a, b in zip(cuts, [*cuts[1:], len(text)]):
        if m := _FIRST.match(text, a, b):
            out.append((m[1] or m[2], text[m.end() : b].strip()))
    return out


def classify(parts: list[str], choice: bool = True) -> list[tuple[str, str, str]]:
    """(kind, label, text) of paragraphs: stem, option, question or image option.

    The options of a paragraph count if the first continues the run from A; once options have begun,
    any other paragraph is a sub-question, and so is a numbered one where nothing is to be chosen.
    A paragraph of a picture alone, or of one and a lone label, is an image option; a lone label is nothing.
    """
    out: list[tuple[str, str, str]] = []
    held = 0
    for p in parts:
        text = _PICTURE.sub("", p).strip()
        if _PICTURE.search(p) and (not text or _LONE.fullmatch(text)):
            out.append(("image_option", "", p.strip()))
            continue
        own = paragraph_options(text)
        if own and (not held or own[0][0] == chr(ord("A") + held)):
            out += [("option", letter, content) for letter, content in own]
            held += len(own)
        elif text and held:
            out.append(("question", "", text))
        elif text and not choice and _ASKED.match(text):
            out.append(("question", "", text))
        elif text and not _LONE.fullmatch(text):
            out.append(("stem", "", text))
    return out


def classify_paragraphs(df: DataFrame, id: str, html: str, choice: Column | None = None) -> DataFrame:
    """(id, pos, kind, label, text) of the paragraphs of each text; one pass, state inside a row only.

    ``choice`` tells the items whose options are to be chosen from; all are without it.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(i, k, *x) for i, p, c in zip(b["id"], b["parts"], b["choice"]) if p is not None for k, x in enumerate(classify(list(p), bool(c)), 1)]
            yield pd.DataFrame(out, columns=["id", "pos", "kind", "label", "text"])

    kind = df.schema[id].dataType.simpleString()
    chosen = F.lit(True) if choice is None else F.coalesce(choice, F.lit(False))
    slim = df.select(F.col(id).alias("id"), paragraphs(F.col(html)).alias("parts"), chosen.alias("choice"))
    return slim.mapInPandas(rows, f"id {kind}, pos long, kind string, label string, text string").withColumnRenamed("id", id)


IMAGE = r"""(?:<img[^>]*?src\s*=\s*["']?([^"'\s>]+)|!\[[^\]]*\]\(([^)\s]+)\)|picture(?:\[[^\]]*\])?\{([^}]+)\})"""


def image_refs(text: Column) -> Column:
    """Image references in order, each once."""
    return F.array_distinct(image_places(text))


def image_places(text: Column) -> Column:
    """Image references in order, repeats included."""
    found = [F.regexp_extract_all(text, F.lit(IMAGE), F.lit(i)) for i in (1, 2, 3)]
    merged = F.zip_with(F.zip_with(found[0], found[1], lambda a, b: F.concat(a, b)), found[2], lambda a, b: F.concat(a, b))
    return F.filter(merged, lambda x: x != "")


def links(text: Column) -> Column:
    """Link targets of HTML and Markdown in order, each once."""
    found = [F.regexp_extract_all(text, F.lit(r"""(?:<a\b[^>]*?href\s*=\s*["']?([^"'\s>]+)|(?<!!)\[[^\]\n]*\]\(([^()\s]+)\))"""), F.lit(i)) for i in (1, 2)]
    return F.array_distinct(F.filter(F.zip_with(*found, lambda a, b: F.concat(a, b)), lambda x: x != ""))
