"""Problem 8: find the evaluation texts that leak into a corpus.

Method: the test items form a BM25 inverted index over overlapping shingles of their letters
and digits. Every passage of every document (overlapping windows, so that each run of ``run``
characters lies whole in one of them) queries the index; block-max WAND walks the postings of
the passage's shingles and skips blocks whose upper bound cannot reach the threshold. The
threshold of an item is the least score that any of its own runs of ``run`` characters gives,
so no leak can score below it. What is retrieved is verified exactly on letters and digits.

Scale: the index is made of arrays, built once on the driver and broadcast. An item takes at most
about 40 bytes a letter there, so ``most_chars`` bounds a broadcast (80 MB); beyond it the items are
taken in blocks that each pass over the corpus, one block on the driver at a time. The corpus is
never shuffled or collected. Windows without any indexed shingle are dropped by one vectorised look-up.

Defined results: null and empty texts leak nothing; items shorter than ``run`` cannot leak; a
document that repeats is listed under each of its ids; repeated ids give one row a pair.
"""

from __future__ import annotations

import functools
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from sheafline.llm.letters import letters
from sheafline.session import spread

K1, B = 1.2, 0.75
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 1 << 20


def shingles(code: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each ``width`` consecutive code points."""
    n = len(code) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, power, have = np.zeros(n, np.uint64), code.astype(np.uint64) * _BASE ^ np.uint64(0xD6E8FEB86659FD93), 1
    # doubling: hashes of 1, 2, 4, .. characters are joined to the width that is asked for
    done, at = 0, power
    left = width
    while left:
        if left & 1:
            out = out * np.uint64(0xFF51AFD7ED558CCD) + at[done : done + n]
            out ^= out >> np.uint64(29)
            done += have
        left >>= 1
        if left:
            at = (at[:-have] * np.uint64(0xC4CEB9FE1A85EC53) + at[have:]) if len(at) > have else at[:0]
            at = at ^ (at >> np.uint64(31))
            have *= 2
    return out


class ItemIndex:
    """BM25 index of a bounded set of items with block maxima, as arrays: built once, then broadcast.

    ``terms`` are sorted; the postings of term ``t`` are ``docs[at[t] : at[t + 1]]`` with their scores.
    """

    def __init__(self, items: list[tuple[int, str]], run: int = 50, width: int = 12, block: int = 64):
        self.run, self.width, self.block = run, width, block
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        grams = [shingles(points(t), width) for t in self.texts]
        n, size = len(items), np.array([max(len(g), 1) for g in grams], float)
        norm = K1 * (1 - B + B * size / (size.mean() if n else 1))
        term = np.concatenate(grams) if n else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(n), [len(g) for g in grams])
        order = np.lexsort((owner, term))
        by_term, by_owner = term[order], owner[order]
        first = np.flatnonzero(np.append(True, (by_term[1:] != by_term[:-1]) | (by_owner[1:] != by_owner[:-1]))[: len(term)])
        count = np.diff(np.append(first, len(term)))
        self.docs = by_owner[first].astype(np.int32)
        begin = np.flatnonzero(np.append(True, by_term[first][1:] != by_term[first][:-1])[: len(first)])
        self.terms, self.at = by_term[first][begin], np.append(begin, len(first))
        held = np.diff(self.at)
        idf = np.repeat(np.log(1 + (n - held + 0.5) / (held + 0.5)), held)
        self.scores = idf * count * (K1 + 1) / (count + norm[self.docs])
        self.most = np.maximum.reduceat(self.scores, begin) if len(begin) else np.empty(0)
        # the least sum that a run of an item's own can give; a shingle that stands in a run before is left out of
        # it, which only lowers the bound
        own = np.empty(len(term))
        own[order] = np.repeat(self.scores, count)
        place = np.arange(len(term))
        again = np.zeros(len(term), bool)
        near = np.flatnonzero((by_term[1:] == by_term[:-1]) & (by_owner[1:] == by_owner[:-1])) + 1
        again[order[near]] = place[order[near]] - place[order[near - 1]] < run - width + 1
        own[again] = 0
        total, span = np.append(0, np.cumsum(own)), run - width + 1
        self.least = np.full(n, np.inf)
        at = np.append(0, np.cumsum([len(g) for g in grams])).astype(np.int64)
        for d in range(n):
            if at[d + 1] - at[d] >= span:
                self.least[d] = (total[at[d] + span : at[d + 1] + 1] - total[at[d] : at[d + 1] - span + 1]).min()
        self.least -= 1e-6
        self.floor = float(self.least.min()) if n else np.inf
        self.slots = np.zeros(_SLOTS, bool)
        self.slots[(self.terms & np.uint64(_SLOTS - 1)).astype(np.int64)] = True
        self.lists: dict[int, tuple] = {}

    @property
    def nbytes(self) -> int:
        """What a broadcast of this index takes."""
        return sum(x.nbytes for x in (self.docs, self.terms, self.at, self.scores, self.most, self.least, self.slots)) + sum(4 * len(t) for t in self.texts)

    def postings(self, t: int) -> tuple[list[int], list[float], list[tuple[int, float]]]:
        """Documents, scores, and (last document, greatest score) of each block of a term that a text holds."""
        if t not in self.lists:
            docs, scores = self.docs[self.at[t] : self.at[t + 1]].tolist(), self.scores[self.at[t] : self.at[t + 1]].tolist()
            step = self.block
            self.lists[t] = docs, scores, [(docs[min(i + step, len(docs)) - 1], max(scores[i : i + step])) for i in range(0, len(docs), step)]
        return self.lists[t]

    def wand(self, query: list[int]) -> list[int]:
        """Items whose score over the query's distinct shingles reaches their threshold (block-max WAND)."""
        if float(self.most[query].sum()) < self.floor:
            return []
        cursors = [[x[0][0], 0, *x, float(self.most[t])] for t in query for x in (self.postings(t),)]
        found = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                bound += c[5]
                if bound >= self.floor:
                    pivot = k
                    break
            if pivot < 0:
                return found
            doc = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == doc:
                pivot += 1
            blocks = sum(next((m for last, m in c[4][c[1] // self.block :] if last >= doc), 0.0) for c in cursors[: pivot + 1])
            if blocks < self.floor or cursors[0][0] == doc:
                if blocks >= self.floor and sum(c[3][c[1]] for c in cursors[: pivot + 1]) >= self.least[doc]:
                    found.append(doc)
                target = doc + 1
                if blocks < self.floor:  # no document before the nearest block end can reach the threshold
                    ends = [next((last for last, _ in c[4][c[1] // self.block :] if last >= doc), doc) for c in cursors[: pivot + 1]]
                    nxt = cursors[pivot + 1][0] if pivot + 1 < len(cursors) else math.inf
                    target = max(doc + 1, min(min(ends) + 1, nxt))
            else:
                target = doc
            for c in cursors[: pivot + 1]:
                if c[0] < target:
                    c[1] = bisect_left(c[2], target, c[1])
                    c[0] = c[2][c[1]] if c[1] < len(c[2]) else math.inf
            cursors = [c for c in cursors if c[0] != math.inf]
        return found

    def leaked(self, texts: list[str]) -> list[tuple[int, int]]:
        """(text ordinal, item ordinal) of every verified leak; texts are letters and digits."""
        joined = "".join(texts)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        end = np.cumsum(size)
        grams = shingles(points(joined), self.width)
        if not len(grams) or not len(self.terms):
            return []
        hit = np.flatnonzero(self.slots[(grams & np.uint64(_SLOTS - 1)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.terms, grams[hit]), len(self.terms) - 1)
        known = self.terms[place] == grams[hit]
        hit, place = hit[known], place[known]
        text = np.searchsorted(end, hit, side="right")
        inside = hit + self.width <= end[text]
        hit, text, place = hit[inside], text[inside], place[inside].tolist()
        offset = hit - (end[text] - size[text])
        window, step = 2 * self.run, self.run
        found: set[tuple[int, int]] = set()
        tried: set[tuple[int, int]] = set()
        # a shingle at offset o lies in the windows that begin at step * w for o - window + width <= step * w <= o
        per: dict[tuple[int, int], list[int]] = {}
        for k, (t, o) in enumerate(zip(text.tolist(), offset.tolist())):
            for w in range(max(0, -(-(o - window + self.width) // step)), o // step + 1):
                per.setdefault((t, w), []).append(k)
        need = self.run - self.width + 1
        for (t, _), at in per.items():
            if at[-1] - at[0] + 1 < need or len(at) < need:
                continue
            for d in self.wand(list(dict.fromkeys(place[k] for k in at))):
                if (t, d) not in tried:
                    tried.add((t, d))
                    if self.verify(texts[t], d):
                        found.add((t, d))
        return sorted(found)

    def verify(self, text: str, d: int) -> bool:
        """Whether a run of an item stands in a text: any such run holds a whole piece of half its length."""
        item, run = self.texts[d], self.run
        half = run // 2
        for i in range(0, len(item) - half + 1, half):
            piece, at = item[i : i + half], text.find(item[i : i + half])
            while at >= 0:
                a, b = 0, half
                while b - a < run and i + a - 1 >= 0 and at + a - 1 >= 0 and item[i + a - 1] == text[at + a - 1]:
                    a -= 1
                while b - a < run and i + b < len(item) and at + b < len(text) and item[i + b] == text[at + b]:
                    b += 1
                if b - a >= run:
                    return True
                at = text.find(piece, at + 1)
        return False

    def overlap(self, text: str, d: int) -> int:
        """The length of the longest run of an item's letters and digits in a text."""
        item, best = self.texts[d], self.run - 1
        for i in range(len(item)):
            while i + best + 1 <= len(item) and item[i : i + best + 1] in text:
                best += 1
        return best


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def leaks_found(corpus: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "eval_id", item_text: str = "text", run: int = 50, most_chars: int = 2_000_000, answer: str | None = None) -> DataFrame:
    """(id, item_id) of every document that holds ``run`` consecutive letters and digits of an item.

    With ``answer``, a column of the items, two more columns tell how much leaked: ``overlap``, the
    longest run of the question, and ``answered``, whether the letters and digits of the answer occur
    in the document too (never for an item without an answer).
    """
    spark = corpus.sparkSession
    ids = corpus.schema[id].dataType
    schema = T.StructType([T.StructField(id, ids), T.StructField(item_id, items.schema[item_id].dataType)])
    if answer:
        schema = T.StructType([*schema.fields, T.StructField("overlap", T.IntegerType()), T.StructField("answered", T.BooleanType())])
    slim = spread(corpus.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text")).where("text is not null"))
    def scan(block: list[tuple[int, str, str]]) -> DataFrame:
        index = ItemIndex([(i, t) for i, t, _ in block], run)
        shared = spark.sparkContext.broadcast((index, [a for _, _, a in block]))

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, answers = shared.value
            for b in batches:
                texts = [letters(t) for t in b.column(1).to_pylist()]
                pairs = own.leaked(texts)
                if pairs:
                    cols = [b.column(0).take(pa.array([t for t, _ in pairs])), pa.array([own.ids[d] for _, d in pairs])]
                    if answer:
                        cols += [pa.array([own.overlap(texts[t], d) for t, d in pairs], pa.int32()), pa.array([bool(answers[d]) and answers[d] in texts[t] for t, d in pairs])]
                    yield pa.RecordBatch.from_arrays(cols, names=schema.names)

        return slim.mapInArrow(rows, schema)

    # the items stream through the driver, which holds one block of them at a time
    found, block, held = [], [], 0
    for r in items.select(F.col(item_id).alias("i"), F.col(item_text).cast("string").alias("t"), (F.col(answer).cast("string") if answer else F.lit("")).alias("a")).distinct().toLocalIterator():
        own = letters(r.t)
        if len(own) >= run:
            if held and held + len(own) > most_chars:
                found.append(scan(block))
                block, held = [], 0
            block.append((r.i, own, letters(r.a)))
            held += len(own)
    found.append(scan(block))
    return functools.reduce(DataFrame.unionByName, found).dropDuplicates()
