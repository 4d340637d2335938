"""Problem 7: encode every text with a public byte-level BPE tokenizer.

Method: forced-boundary splitting. A pair of adjacent bytes that occurs inside no token of
the vocabulary can never be joined by a merge, so the text may be cut there without changing
its encoding. Pre-token boundaries and these forced cuts give short fragments; the distinct
fragments of a batch are encoded once each and the ids are put together again in order.
All byte work is on the batch's UTF-8 buffer with numpy; nothing is shuffled.

Defined results: null and empty text give an empty list; special tokens are ordinary text;
one row comes out per input row, repeated rows included; the id column may hold nulls.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from sheafline.session import spread

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pre-token pattern that belongs to the published vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts are encoded in runs of about so many characters, which bounds a worker's memory.
RUN_CHARS = 1 << 20
#: Fragments of up to seven bytes are packed with their length into one integer.
SHORT = 7


class ForcedBoundaryEncoder:
    """Encoder over one rank file (base64 token, rank)."""

    def __init__(self, path: str = VOCABULARY, pattern: str = PATTERN):
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        self.ranks = ranks
        self.core = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        # white space as the published encoders count it: the Unicode property, without U+001C to U+001F
        exact = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")
        self.split = regex.compile(exact).findall
        inside = np.zeros(65536, bool)
        for token in ranks:
            if len(token) > 1:
                b = np.frombuffer(token, np.uint8).astype(np.uint32)
                inside[b[:-1] << 8 | b[1:]] = True
        #: pair code -> True where the pair is inside no token
        self.forced = ~inside
        self.memo: dict[bytes, list[int]] = {}

    def fragment(self, b: bytes) -> list[int]:
        """Ids of one fragment; a bounded memo holds the frequent ones."""
        ids = self.memo.get(b)
        if ids is None:
            rank = self.ranks.get(b)
            ids = [rank] if rank is not None else self.core._encode_single_piece(b)
            if len(self.memo) < 200_000 and len(b) <= 32:
                self.memo[b] = ids
        return ids

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids, and the number of ids of each text."""
        data = "".join(texts).encode("utf-8", "replace")
        if not data:
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        buf = np.frombuffer(data, np.uint8)
        n = len(buf)
        first = np.append(np.flatnonzero((buf & 0xC0) != 0x80), n)  # byte at which each character starts
        starts = np.zeros(n + 1, bool)
        wide = buf.astype(np.uint32)
        starts[1:n] = self.forced[wide[:-1] << 8 | wide[1:]]
        sizes: list[int] = []
        for t in texts:
            sizes.extend(map(len, self.split(t)))
        ends = np.cumsum(np.asarray(sizes, np.int64))
        starts[first[ends]] = True
        starts[0] = starts[n] = True
        cut = np.flatnonzero(starts)
        at, size = cut[:-1], np.diff(cut)
        short = size <= SHORT
        key = np.zeros(len(at), np.uint64)
        for i in range(SHORT):
            own = short & (size > i)
            key[own] |= buf[at[own] + i].astype(np.uint64) << np.uint64(8 * i)
        key |= np.where(short, size, 0).astype(np.uint64) << np.uint64(56)
        long = np.flatnonzero(~short)
        if len(long):  # longer fragments are numbered by their bytes
            seen: dict[bytes, int] = {}
            key[long] = [seen.setdefault(data[a : a + s], len(seen)) for a, s in zip(at[long].tolist(), size[long].tolist())]
        kinds, where, inverse = np.unique(key, return_index=True, return_inverse=True)
        coded = [self.fragment(data[a : a + s]) for a, s in zip(at[where].tolist(), size[where].tolist())]
        count = np.fromiter(map(len, coded), np.int64, len(coded))
        flat = np.fromiter((x for c in coded for x in c), np.int32, int(count.sum()))
        begin = np.cumsum(count) - count
        each = count[inverse]
        out_begin = np.cumsum(each) - each
        total = int(each.sum())
        ids = flat[np.repeat(begin[inverse] - out_begin, each) + np.arange(total)]
        chars = np.fromiter(map(len, texts), np.int64, len(texts))
        bounds = first[np.concatenate([[0], np.cumsum(chars)])]  # byte at which each text starts
        through = np.append(out_begin, total)[np.searchsorted(at, bounds)]
        return ids, np.diff(through)


@functools.lru_cache(2)
def encoder(path: str, pattern: str) -> ForcedBoundaryEncoder:
    return ForcedBoundaryEncoder(path, pattern)


def runs(texts: list[str], most: int) -> Iterator[list[str]]:
    """Consecutive texts of together about ``most`` characters; a longer text is a run of its own."""
    own, held = [], 0
    for t in texts:
        if own and held + len(t) > most:
            yield own
            own, held = [], 0
        own.append(t)
        held += len(t)
    if own:
        yield own


def encode_corpus(df: DataFrame, text: str = "text", id: str = "doc_id", path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(id, ids) of every row; see the module for nulls, empties and repeats."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for b in batches:
            parts = [enc.encode(own) for own in runs([t or "" for t in b.column(1).to_pylist()], RUN_CHARS)]
            if not parts:
                continue
            ids = np.concatenate([p[0] for p in parts])
            ends = np.concatenate([[0], np.cumsum(np.concatenate([p[1] for p in parts]))])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), lists], names=["id", "ids"])

    slim = spread(df.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text")))
    schema = T.StructType([T.StructField("id", slim.schema["id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return slim.mapInArrow(rows, schema).withColumnRenamed("id", id)
