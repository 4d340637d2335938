"""Problem 2: bring visually identical text to one form.

Method: a quick check finds the characters that may be unstable (normalisation quick-check
"no" or "maybe", and the fold sets below). Texts without any are returned as they are, on the
JVM side. In the others each unstable segment is extended to its boundary context (the starter
before it and the marks after it; the letter run and its neighbours for look-alike letters),
only that segment is normalised, and the canonical segments are spliced into the unchanged text.

One form: full-width letters and digits become ASCII; marks are composed where a composed
character exists; invisible characters go; no-break spaces become blanks; signs that stand for
a letter, radicals that stand for an ideograph, and letters of another script inside Latin text
become the usual character. Chinese punctuation, symbols in Greek, superscripts, circled digits
and words of other languages stay. Normalising twice changes nothing.

Defined results: null stays null and is no case; empty text is unchanged; rows are independent,
so repeated rows and ids give repeated results.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from sheafline.llm.fields import FIELDS, long_fields
from sheafline.session import spread

#: Letters of other scripts and the Latin letter each one looks like.
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТУХаеорсухіјѕһԁԛԝҮ", "ABESIJKMHOPCTYXaeopcyxijshdqwY"))
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹοϲνι", "ABEZHIKMNOPTYXCocvi"))
#: Greek letters that alone are an ordinary symbol.
GREEK_SYMBOLS = frozenset("νι")
#: Simplified and other radicals of the supplement block, and the ideograph of each.
RADICALS = dict(
    zip(
        "⺁⺄⺅⺆⺉⺊⺋⺎⺏⺐⺒⺓⺔⺕⺖⺘⺙⺛⺝⺞⺟⺠⺡⺢⺣⺤⺦⺧⺨⺩⺪⺬⺭⺮⺯⺰⺱⺲⺸⺹⺺⺻⺼⺽⺾⻁⻂⻃⻄⻅⻆⻈⻉⻊⻋⻌⻏⻐⻑⻒⻓⻔⻕⻖⻗⻘⻙⻚⻛⻜⻝⻟⻠⻡⻢⻣⻤⻥⻦⻧⻨⻩⻪⻫⻬⻭⻮⻯⻰⻱⻲⻳",
        "厂乙亻冂刂卜㔾兀尣尢巳幺彑彐忄扌攵旡月歺母民氵氺灬爫丬牛犭王疋示礻竹糹纟罓罒羋耂肀聿肉臼艹虎衤覀西见角讠贝足车辶阝钅長镸长门阜阝雨青韦页风飞食飠饣首马骨鬼鱼鸟卤麦黄黾斉齐歯齿竜龙龜亀龟",
    )
)
RADICALS |= {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in range(0x2F00, 0x2FD6)}
WIDE = {chr(c): chr(c - 0xFEE0) for a, b in ((0xFF10, 0xFF19), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A)) for c in range(a, b + 1)}
#: Half-width kana and Hangul letters; the voice marks become combining ones and join their letter.
WIDE |= {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in (*range(0xFF66, 0xFFBF), *range(0xFFC2, 0xFFDD)) if unicodedata.category(chr(c)) in ("Lo", "Lm")}
BLANKS = "   "
INVISIBLE = "­͏؜᠎​‌‍‎‏⁠⁡⁢⁣⁤﻿"
#: Signs whose compatibility form is one letter, and Latin ligatures.
SIGNS = {
    chr(c): n
    for a, b in ((0xB5, 0xB5), (0x2100, 0x214F), (0xFB00, 0xFB06), (0x1D400, 0x1D7CB))
    for c in range(a, b + 1)
    if unicodedata.category(chr(c))[0] in "LS" and (n := unicodedata.normalize("NFKC", chr(c))) != chr(c) and n.isalpha() and (len(n) == 1 or c >= 0xFB00)
}
FOLD = {**WIDE, **{c: " " for c in BLANKS}, **SIGNS, **RADICALS}
ALIKE = {**CYRILLIC, **GREEK}

_set = lambda chars: "".join(re.escape(c) for c in sorted(chars))


def _ranges(codes: list[int]) -> str:
    """A character class of these code points."""
    out: list[list[int]] = []
    for c in codes:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(re.escape(chr(a)) + ("-" + re.escape(chr(b)) if b > a else "") for a, b in out)


#: Marks and other characters whose quick-check property is "maybe" or "no", variation selectors
#: aside: those of the basic plane, and those beyond.
MAYBE_CODES = tuple(
    [
        c
        for c in codes
        if not 0xD800 <= c < 0xE000 and not 0xFE00 <= c <= 0xFE0F and (unicodedata.category(chr(c))[0] == "M" or 0x1160 <= c <= 0x11FF or not unicodedata.is_normalized("NFC", chr(c)))
    ]
    for codes in (range(0x300, 0x10000), range(0x10000, 0x30000))
)
MAYBE = _ranges(MAYBE_CODES[0] + MAYBE_CODES[1])
QUICK = f"[{_set(FOLD.keys() | ALIKE.keys())}{_set(INVISIBLE)}{MAYBE}]"
UNSTABLE = re.compile(QUICK)
#: The quick check on the JVM side: a few ranges that hold no unstable character, and everything outside them.
STABLE = r"\x00-\x7f\u4e00-\u9fff\u3001-\u3029\uff01-\uff0f\uff1a-\uff20\u2018-\u2026\u00b0\u00b2\u00d7\u03a9\u03bc"
#: The engine is quick only on classes inside the basic plane, so what lies beyond is looked for apart.
_BEYOND = re.compile("[\U00010000-\U0010ffff]")
_BASIC = re.compile(f"[{_set(c for c in (FOLD.keys() | ALIKE.keys()) if c < chr(0x10000))}{_set(INVISIBLE)}{_ranges(MAYBE_CODES[0])}]")
_FOLDED = re.compile(f"[{_set(c for c in FOLD if c < chr(0x10000))}]")
_FOLDED_BEYOND = re.compile(f"[{_set(c for c in FOLD if c >= chr(0x10000))}]")
_HIDDEN = re.compile(f"[{_set(INVISIBLE)}]")
_MARKED = re.compile(f"(?s).[{MAYBE}]+|[{MAYBE}]")
_ALIKE = re.compile(f"[{_set(ALIKE)}]")
_RUN = re.compile(r"[A-Za-zÀ-ɏͰ-ϿЀ-ԯ]+")
_CYRILLIC = re.compile(r"[Ѐ-ԯ]")
_STOP = re.compile(r"[。！？!?\n]")
_LATIN = re.compile(r"[A-Za-zÀ-ɏ]")
#: Joiners belong to the text between emoji and after letters of scripts that are shaped.
_SHAPED = re.compile("[؀-ۿݐ-ݿऀ-෿က-႟ក-៿←-⯿️\U0001f000-\U0001faff]")


def _joins(text: str, at: int) -> bool:
    c = text[at]
    return c in "\u200c\u200d" and 0 < at < len(text) - 1 and bool(_SHAPED.match(text[at - 1])) and bool(_SHAPED.match(text[at + 1]))


def _latinise(text: str) -> str:
    """Look-alike letters of other scripts inside Latin text, and option letters, as Latin letters."""
    runs = [(m.start(), m.end(), m[0]) for m in _RUN.finditer(text)]
    script = []  # L: Latin or mixed with look-alikes; O: a word of another script; ?: look-alikes alone
    for _, _, w in runs:
        alien = [c for c in w if not _LATIN.match(c)]
        own = [c for c in alien if c not in ALIKE]
        if not alien:
            script.append("L")
        elif not own:
            script.append("M" if len(alien) < len(w) else "?")
        elif len(own) < len(alien) and len(own) == 1 and not _CYRILLIC.match(own[0]) and all(_CYRILLIC.match(c) or c in "Ϲϲ" for c in alien if c in ALIKE):
            script.append("M")  # a Greek symbol before a stand-in, as in units
        elif len(alien) < len(w) and any(_CYRILLIC.match(c) for c in alien if c in ALIKE) and not any(_CYRILLIC.match(c) for c in own):
            script.append("M")
        else:
            script.append("O" if any(_CYRILLIC.match(c) for c in own) or len(w) > 2 and len(alien) == len(w) else "S")
    # the script of the nearest decided run before and after each run, within its sentence
    before_, after_ = [""] * len(runs), [""] * len(runs)
    for side, order in ((before_, range(len(runs))), (after_, range(len(runs) - 1, -1, -1))):
        held, last = "", None
        for k in order:
            if last is not None and _STOP.search(text, min(runs[k][1], runs[last][1]), max(runs[k][0], runs[last][0])):
                held = ""
            side[k] = held
            held = held if script[k] in "?S" else script[k]
            last = k
    parts, done = [], 0
    for k, (a, b, w) in enumerate(runs):
        if script[k] == "?":
            greek = not _CYRILLIC.search(w)
            foreign = "O" in (before_[k], after_[k])
            if greek:
                turn = any(c not in GREEK_SYMBOLS for c in w) and not (foreign and len(w) > 1)
            else:
                before, after = text[:a].rstrip(" ")[-1:], text[b : b + 1]
                turn = not foreign or len(w) == 1 and w.isupper() and (after in tuple("．、)）.") and before in ("", "\n", "（", "(", "。", "？", "?", ">") or before.isdigit() and not after.isalpha())
        else:
            turn = script[k] == "M"
        if turn and (new := "".join(ALIKE.get(c, c) for c in w)) != w:
            parts += [text[done:a], new]
            done = b
    return "".join([*parts, text[done:]]) if parts else text


def unstable(text: str) -> bool:
    """Whether a text holds any character of the quick check's "maybe" or "no"."""
    return bool(_BASIC.search(text)) or bool(_BEYOND.search(text)) and bool(UNSTABLE.search(text))


def unify(text: str) -> tuple[str, list[str]]:
    """The one form of a text, and the kinds of stand-ins it held."""
    kinds: list[str] = []
    while unstable(text):  # each round removes a stand-in or ends
        out, own = _round(text)
        kinds += [k for k in own if k not in kinds]
        if out == text:
            break
        text = out
    return text, kinds


def _round(text: str) -> tuple[str, list[str]]:
    kinds = []
    if _HIDDEN.search(text):
        out = _HIDDEN.sub(lambda m: m[0] if _joins(text, m.start()) else "", text)
        if out != text:
            kinds.append("invisible")
            text = out
    for folded in (_FOLDED, _FOLDED_BEYOND) if _BEYOND.search(text) else (_FOLDED,):
        if folded.search(text):
            kinds += sorted({"space" if c in BLANKS else "width" if c in WIDE else "radical" if c in RADICALS else "sign" for c in folded.findall(text)} - set(kinds))
            text = folded.sub(lambda m: FOLD[m[0]], text)
    if not unicodedata.is_normalized("NFC", text):
        kinds.append("combining")
        text = _MARKED.sub(lambda m: unicodedata.normalize("NFC", m[0]), text)
        if not unicodedata.is_normalized("NFC", text):  # marks whose order reaches past one segment
            text = unicodedata.normalize("NFC", text)
    if _ALIKE.search(text) and (out := _latinise(text)) != text:
        kinds.append("script")
        text = out
    return text, kinds


def unify_fields(df: DataFrame, id: str = "item_id", fields: tuple[str, ...] = FIELDS, only_cases: bool = False) -> DataFrame:
    """(id, field, text, kinds) in the one form; ``kinds`` is empty where nothing stood in for anything."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [unify(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.list_(pa.string()))], names=["id", "field", "text", "kinds"])

    unstable = F.col("text").rlike(f"[^{STABLE}]")
    long = long_fields(spread(df.select(id, *fields)), id, fields)
    schema = T.StructType([T.StructField("id", long.schema["id"].dataType), T.StructField("field", T.StringType()), T.StructField("text", T.StringType()), T.StructField("kinds", T.ArrayType(T.StringType()))])
    out = long.where(unstable).mapInArrow(rows, schema)
    if only_cases:
        out = out.where(F.size("kinds") > 0)
    else:
        out = out.unionByName(long.where(~unstable).withColumn("kinds", F.array().cast("array<string>")))
    return out.withColumnRenamed("id", id)
