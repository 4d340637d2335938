"""Problem 4: split fields that pack several values, one row per value with its position.

Method: the Arrow string buffer of a batch is scanned as one array of code points. Quote
parity and bracket depth give a mask of the characters that belong to a value whatever they
are; separator masks outside it give the cuts; masks of blanks and quotes move the cuts to the
edges of the values; their bytes are taken out of the buffer at once, which gives the child of a
list array whose offsets are the numbers of values. The lists are flattened with the parent's
ordinal. Rows whose quotes or brackets do not pair up, and options, are read by a scanner instead, so that no row is lost.

Defined results
* null, empty and blank bodies, and bodies of a single value, give no row;
* an unpaired straight quote is an ordinary character from there on; an opening mark that is
  never closed is an ordinary character, and so is a closing mark that was never opened;
* ``pos`` counts the non-empty values from 1; repeated ids are split independently;
* in the slot of options the cuts are the option labels alone, in ascending letters; text
  before the first label is a value only if nothing else stands for it (it is dropped as stem).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from sheafline.session import spread

#: Separators in every slot but options, and the marks that protect them.
SEPARATORS = ",，、;；|｜\t\n\r\x0b\x0c  \x85"
BLANKS = "                　"
OPENERS = {"(": ")", "（": "）", "“": "”", "「": "」", "『": "』", "‘": "’"}
ENCLOSING = {'"': '"', "“": "”", "「": "」", "『": "』", "‘": "’"}
TRAILING = SEPARATORS + BLANKS
LABEL = re.compile(r"(?:^|(?<=[\s,，、;；|]))(?:[（(]\s*([A-Z])\s*[)）][．.、:：]?|([A-Z])[．.、:：)）])\s*")
#: The same labels where nothing but the letters' order tells them from the text before.
TIGHT = re.compile(r"(?:[（(]\s*([A-Z])\s*[)）]|([A-Z])[．、])\s*")
#: Up to here letters need only ascend; beyond, where they are often symbols, each must follow the one before.
LAST_FREE = "I"

_KIND = np.zeros(0x110000, np.uint8)  # 1 separator, 2 blank, 3 straight quote, 4 opener, 5 closer, 6 slash
for _chars, _kind in ((SEPARATORS, 1), (BLANKS, 2), ('"＂', 3), (OPENERS, 4), (OPENERS.values(), 5), ("/／", 6)):
    for _c in _chars:
        _KIND[ord(_c)] = _kind

_PAIR = np.zeros(0x110000, np.uint8)  # the number of the pair that a mark belongs to
for _i, (_a, _b) in enumerate(OPENERS.items()):
    _PAIR[ord(_a)] = _PAIR[ord(_b)] = _i + 1

#: The closing mark of each mark that can enclose a value, the marks of quotation, and white space.
_CLOSE = np.zeros(0x110000, np.uint32)
for _a, _b in ENCLOSING.items():
    _CLOSE[ord(_a)] = ord(_b)
_MARK = np.zeros(0x110000, bool)
_MARK[[ord(c) for pair in ENCLOSING.items() for c in pair]] = True
_SPACE = np.zeros(0x110000, bool)
_SPACE[[i for i in range(0x3001) if chr(i).isspace()]] = True


def tidy(value: str) -> str:
    """A value without outer blanks, trailing separators and enclosing quotes."""
    value = value.strip(TRAILING)
    if len(value) >= 2 and (close := ENCLOSING.get(value[0])) and value[-1] == close:
        inner = value[1:-1]
        if close == '"':
            if '"' not in inner.replace('""', ""):
                return inner.replace('""', '"').strip()
        elif value[0] not in inner and close not in inner:
            return inner.strip()
    return value


def options(body: str) -> list[str]:
    """Values between option labels whose letters ascend."""
    for pattern in (LABEL, TIGHT):
        found, last = [], ""
        for m in pattern.finditer(body):
            letter = m[1] or m[2]
            if letter == "A" and not last or last and (last < letter <= LAST_FREE or letter > LAST_FREE and ord(letter) == ord(last) + 1):
                found.append(m)
                last = letter
        if len(found) > 1:
            ends = [m.start() for m in found[1:]] + [len(body)]
            return [v for m, e in zip(found, ends) if (v := tidy(body[m.end() : e]))]
    return []


def scan(body: str, blanks: bool) -> list[str]:
    """The exact scanner, for rows whose marks do not pair up."""
    n, protected, i = len(body), bytearray(len(body)), 0
    pair: dict[int, int] = {}  # the place of each mark's partner, by kind of bracket
    stacks: dict[str, list[int]] = {close: [] for close in OPENERS.values()}
    for j, c in enumerate(body):
        if c in OPENERS:
            stacks[OPENERS[c]].append(j)
        elif stacks.get(c):
            pair[stacks[c].pop()] = j
    while i < n:
        c = body[i]
        if c in '"＂':
            j = i + 1
            while j < n and (body[j] != c or body[j + 1 : j + 2] == c):
                j += 2 if body[j] == c else 1
            end = j if j < n else -1
        elif c in OPENERS:
            end = pair.get(i, -1)
        else:
            end = -1
        if end > i:
            protected[i : end + 1] = b"\1" * (end + 1 - i)
            i = end
        i += 1
    values, begin = [], 0
    for i, c in enumerate(body):
        if not protected[i] and (c in SEPARATORS or blanks and c in BLANKS or c in "/／" and 0 < i < n - 1 and body[i - 1] in TRAILING and body[i + 1] in TRAILING):
            values.append(body[begin:i])
            begin = i + 1
    return [v for x in [*values, body[begin:]] if (v := tidy(x))]


class Flat:
    """The strings of an Arrow array as one array of code points; ``begin`` and ``end`` of each row in it."""

    def __init__(self, rows: pa.StringArray):
        rows = rows.cast(pa.large_string())
        _, offsets, data = rows.buffers()
        offsets = np.frombuffer(offsets, np.int64)[rows.offset : rows.offset + len(rows) + 1]
        self.bytes = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
        lead = (self.bytes & 0xC0) != 0x80
        self.code = np.frombuffer(self.bytes.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
        #: the byte at which each code point begins
        self.byte = np.append(np.flatnonzero(lead), len(self.bytes))
        points = np.append(0, np.cumsum(lead))[offsets - offsets[0]]
        self.begin, self.end = points[:-1], points[1:]

    def strings(self, a: np.ndarray, b: np.ndarray) -> pa.Array:
        """The texts of ascending ranges of code points: one cut through the bytes."""
        x, y = self.byte[a], self.byte[b]
        edges = np.zeros(len(self.bytes) + 1, np.int8)
        np.add.at(edges, x, 1)
        np.add.at(edges, y, -1)
        data = self.bytes[np.cumsum(edges[:-1]).astype(bool)]
        return pa.Array.from_buffers(pa.large_string(), len(a), [None, pa.py_buffer(np.append(0, np.cumsum(y - x)).astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())])


def split_rows(bodies: pa.StringArray, blanks: np.ndarray) -> tuple[pa.ListArray, np.ndarray]:
    """The values of each row as a list array, and which rows are odd and left to ``scan``.

    ``blanks`` tells the rows that blanks split too.
    """
    flat = Flat(bodies)
    code, begin, end = flat.code, flat.begin, flat.end
    n = len(begin)
    if not len(code):
        return pa.LargeListArray.from_arrays(np.zeros(n + 1, np.int64), pa.array([], pa.large_string())), np.zeros(n, bool)
    kind = _KIND[code]
    size = end - begin
    full = size > 0
    row = np.repeat(np.arange(n), size)

    def total(mask: np.ndarray) -> np.ndarray:
        """Running count inside each row, the character itself included."""
        c = np.cumsum(mask)
        return c - np.append(0, c)[begin][row]

    def per_row(values: np.ndarray, how) -> np.ndarray:
        out = np.zeros(n, np.int64)
        out[full] = how.reduceat(values, begin[full])
        return out

    quote = kind == 3
    quoted = (total(quote) & 1).astype(bool) | quote
    step = ((kind == 4).astype(np.int64) - (kind == 5)) * ~quoted
    depth = total(step)
    inside = quoted | (depth > 0) | (step != 0)
    soft = (kind == 1) | (kind == 2)
    first, last = np.zeros(len(code), bool), np.zeros(len(code), bool)
    first[begin[full]] = last[end[full] - 1] = True
    slash = (kind == 6) & ~first & ~last & np.append(False, soft[:-1]) & np.append(soft[1:], False)
    cut = ((kind == 1) | slash | (kind == 2) & blanks[row]) & ~inside
    # odd: marks that do not pair up, that nest, or that mix with quotes
    odd = (per_row(quote, np.add) & 1).astype(bool) | (per_row(depth, np.minimum) < 0)
    closing = np.zeros(n, np.int64)
    closing[full] = depth[end[full] - 1]
    mixed = per_row((quote & (total((kind == 4) | (kind == 5)) > 0)).astype(np.int64), np.maximum) > 0
    odd |= (closing != 0) | mixed | (per_row(depth, np.maximum) > 1)
    mark = np.flatnonzero(step)
    opens = np.flatnonzero(step[mark] > 0)
    opens = opens[opens + 1 < len(mark)]
    odd[row[mark[opens[_PAIR[code[mark[opens]]] != _PAIR[code[mark[opens + 1]]]]]]] = True
    # ranges between the cuts of rows that are not odd and have one
    at = np.flatnonzero(cut & ~odd[row])
    cutted = np.flatnonzero(np.bincount(row[at], minlength=n) > 0)
    a, b = np.sort(np.append(begin[cutted], at + 1)), np.sort(np.append(at, end[cutted]))
    a, b, plain = _tidied(code, soft, a, b)
    keep = b > a
    a, b, plain = a[keep], b[keep], plain[keep]
    count = np.bincount(row[a], minlength=n)
    keep = (count > 1)[row[a]]
    a, b, plain = a[keep], b[keep], plain[keep]
    values = flat.strings(a, b)
    if not plain.all():  # quotes that stand inside enclosing ones
        own = values.to_pylist()
        values = pa.array([v if p else tidy(v) for v, p in zip(own, plain)], pa.large_string())
    return pa.LargeListArray.from_arrays(np.append(0, np.cumsum(np.where(count > 1, count, 0))).astype(np.int64), values), odd


def _tidied(code: np.ndarray, soft: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges without outer blanks, separators and enclosing quotes, and whether that is all there is to do."""

    def trim(hard: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.arange(len(code))
        after = np.minimum.accumulate(np.where(hard, place, len(code))[::-1])[::-1]
        before = np.maximum.accumulate(np.where(hard, place, -1))
        x, y = np.append(after, len(code))[a], np.append(-1, before)[b] + 1
        return np.where(x < y, x, a), np.where(x < y, y, a)

    a, b = trim(~soft, a, b)
    two = np.flatnonzero(b - a > 1)
    enclosed = two[(_CLOSE[code[a[two]]] == code[b[two] - 1]) & (_CLOSE[code[a[two]]] > 0)]
    plain = np.ones(len(a), bool)
    if len(enclosed):
        x, y = a[enclosed], b[enclosed]
        seen = np.append(0, np.cumsum(_MARK[code]))
        bare = seen[y - 1] - seen[x + 1] == 0  # no other quote of any kind inside
        plain[enclosed[~bare]] = False
        x, y = trim(~_SPACE[code], x[bare] + 1, y[bare] - 1)
        a, b = a.copy(), b.copy()
        a[enclosed[bare]], b[enclosed[bare]] = x, y
    return a, b, plain


def unpack(df: DataFrame, id: str = "raw_id", slot: str = "slot", body: str = "body", whole: tuple[str, ...] = ("stem",), numbers: tuple[str, ...] = ("numbers",), labelled: tuple[str, ...] = ("options",)) -> DataFrame:
    """(id, pos, value) of every value of every row that packs at least two."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flattened(ids: pa.Array, lists: pa.LargeListArray) -> pa.RecordBatch:
            parent = pc.list_parent_indices(lists).to_numpy()
            pos = np.arange(len(parent)) - lists.offsets.to_numpy()[parent] + 1
            return pa.RecordBatch.from_arrays([ids.take(pa.array(parent)), pa.array(pos, pa.int64()), lists.flatten().cast(pa.string())], names=["id", "pos", "value"])

        for b in batches:
            ids, slots, bodies = b.columns
            choice = pc.is_in(slots, value_set=pa.array(labelled, pa.string()))
            spaced = pc.is_in(slots, value_set=pa.array(numbers, pa.string())).to_numpy(zero_copy_only=False)
            plain = np.flatnonzero(~choice.to_numpy(zero_copy_only=False))
            lists, odd = split_rows(bodies.take(pa.array(plain)), spaced[plain])
            yield flattened(ids.take(pa.array(plain)), lists)
            rest = [(i, scan(bodies[i].as_py(), bool(spaced[i]))) for i in plain[odd].tolist()]
            rest += [(i, options(bodies[i].as_py())) for i in np.flatnonzero(choice.to_numpy(zero_copy_only=False)).tolist()]
            rest = [(i, values) for i, values in rest if len(values) > 1]
            if rest:
                yield flattened(ids.take(pa.array([i for i, _ in rest])), pa.array([values for _, values in rest], pa.large_list(pa.large_string())))

    slim = df.select(F.col(id).alias("id"), F.col(slot).cast("string").alias("slot"), F.col(body).cast("string").alias("body"))
    slim = slim.where(F.col("body").isNotNull() & ~F.coalesce(F.col("slot"), F.lit("")).isin(*whole))
    schema = T.StructType([T.StructField("id", slim.schema["id"].dataType), T.StructField("pos", T.LongType()), T.StructField("value", T.StringType())])
    return spread(slim).mapInArrow(rows, schema).withColumnRenamed("id", id)
