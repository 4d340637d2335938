"""Problem 5: group records whose character-trigram similarity reaches a threshold.

Method: multiple-global-order filtering. Texts are reduced to letters and digits, equal ones to
one representative, and each to its set of trigrams. Let ``n`` be the size of a set and ``t``
the threshold. All orders put rare tokens first (frequencies from a hashed count over all texts).

* Order 0 ranks all tokens. Two similar sets share a token among their first ``n - ceil(t n) + 1``
  tokens, the least token they share. If that one is rare it is a key by itself.
* Otherwise no shared token is rare. Then the prefixes longer by ``s - 1`` share ``s`` frequent
  tokens. ``s - 1`` further global orders each put one hash class of the tokens first; with
  ``s`` tokens shared, the prefixes under at least one of these orders (the tokens of its class
  within the prefix of order 0) share two tokens. A key is a pair of tokens of one order's prefix:
  the filters "shares this token" and "shares that token" are intersected in the key, before any
  pair exists.
* Sizes and a bitmap bound the overlap of what meets under a key; the rest is verified on the texts.
* Verified links and the copies of problem 3 go through large-star / small-star contraction.

Every step is exact: no pair at the threshold is lost. Sets too small to share ``s`` tokens use a
smaller ``s`` (SHARED); sets of more than 512 trigrams are cut into parts by hash.

Scale: a family that may hold a third of all rows would meet itself under every key. Its texts are
first linked to its least text where the first two tokens under two orders agree, verified, and
then never compared with each other again. Keys of rare tokens have at most ``rare`` texts; pairs
of frequent tokens are about as rare; the largest are split into blocks whose meetings go to
different tasks. A text travels once a part with all its keys there. Nothing that grows with the
texts reaches the driver or a broadcast: frequencies have a fixed number of slots and large keys
a fixed maximum.

Defined results: a null body belongs to no group; texts of fewer than three letters are grouped
only with their copies; ids are integers, and rows that repeat one are one record; no candidate is ever dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from sheafline.llm.copies import by_size, field_labels
from sheafline.llm.letters import FieldParser, letters
from sheafline.session import spread, stage, unstage

SLOTS = 1 << 20
PART = 256  # sets of more than twice as many trigrams are cut into parts
WORDS = 6  # 64-bit words of a bitmap
PAIRS_AT_ONCE = 1 << 20
#: Groups of more places than this are compared in blocks of rows.
DENSE = 24
#: Groups of up to this size are stacked.
STACKED = 96
#: Letters whose keys make up one part, which one task holds (about as many keys).
KEYS_A_PART = 1 << 21
#: Shared tokens that prefixes are extended to; the largest that both sets allow is used.
SHARED = (1, 2, 8, 30)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct trigrams of each text, exact 63-bit codes, and the number of them per text."""
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    if len(code) < 3:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    gram = code[:-2] << np.uint64(42) | code[1:-1] << np.uint64(21) | code[2:]
    owner = np.repeat(np.arange(len(texts)), size)[:-2]
    inside = np.arange(len(gram)) + 2 < np.cumsum(size)[owner]
    gram, owner = gram[inside], owner[inside]
    # by text and hash; a text whose trigrams agree in so many bits of the hash keeps them apart all the same
    order = np.argsort(owner.astype(np.uint64) << np.uint64(52) | mix(gram) >> np.uint64(12)) if len(texts) <= 4096 else np.lexsort((gram, owner))
    gram, owner = gram[order], owner[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    return gram[new], np.bincount(owner[new], minlength=len(texts))


def slices(texts: list[str], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of together about ``most`` characters, of 4096 texts at most."""
    a, held = 0, 0
    for i, t in enumerate(texts):
        if i > a and (held + len(t) > most or i - a >= 4096):
            yield a, i
            a, held = i, 0
        held += len(t)
    if a < len(texts):
        yield a, len(texts)


def keyed(df: DataFrame, id: str, body: str, labels: tuple[str, ...]) -> DataFrame:
    """(id, k1, k2, c1, c2, letters): the key of problem 3, that of the letters, and the letters."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = FieldParser(labels).key
        for b in batches:
            texts = b.column(1).to_pylist()
            own = [letters(t) for t in texts]
            k = np.frombuffer(b"".join(map(key, texts)), "<i8").reshape(-1, 2)
            c = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, own)), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x) for x in (k[:, 0], k[:, 1], c[:, 0], c[:, 1])), pa.array(own, pa.string())], names=["id", "k1", "k2", "c1", "c2", "letters"])

    slim = spread(df.select(F.col(id).cast("long").alias("id"), F.col(body).cast("string").alias("body")).where("body is not null and id is not null"))
    return slim.mapInArrow(rows, "id long, k1 long, k2 long, c1 long, c2 long, letters string")


def frequencies(docs: DataFrame) -> np.ndarray:
    """How many texts hold a trigram, hashed into a fixed number of slots."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for b in batches:
            texts = b.column(0).to_pylist()
            for x, y in slices(texts):
                total += np.bincount((mix(trigrams(texts[x:y])[0]) % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["slot", "n"])

    out = np.zeros(SLOTS, np.int64)
    counted = docs.select("letters").mapInArrow(rows, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    out[counted["slot"].to_numpy()] = counted["n"].to_numpy()
    return np.minimum(out, 1 << 30).astype(np.int32)


def parity(gram: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """A bitmap of each text's trigrams in which every trigram flips one bit."""
    bit = (mix(gram, 2) % np.uint64(WORDS * 64)).astype(np.int64)
    odd = np.bincount(owner * (WORDS * 64) + bit, minlength=n * WORDS * 64).reshape(n, WORDS * 64) & 1
    return np.packbits(odd.astype(np.uint8), axis=1)


def ordered_tokens(gram: np.ndarray, size: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, frequency, set, level, set sizes) of all tokens, by set and then rare ones first.

    A set is a text, or a part of a long one: long sets are cut into parts by hash, so that of two
    similar sets at least one pair of parts is as similar; similar sets differ by one level at
    most, so each is cut at two.
    """
    owner = np.repeat(np.arange(len(size)), size)
    h = mix(gram)
    level = np.maximum(0, np.floor(np.log2(np.maximum(size, 1) / PART)).astype(np.int64))[owner]
    again = np.flatnonzero(level)
    at = np.concatenate([np.arange(len(h)), again])
    level = np.concatenate([level, level[again] - 1])
    part = (mix(gram, 7)[at] & ((np.uint64(1) << level.astype(np.uint64)) - np.uint64(1))).astype(np.int64)
    h, owner = h[at], owner[at]
    seen = table[(h % np.uint64(SLOTS)).astype(np.int64)]
    if level.max() > 12:  # more parts than the packed form has room for
        order = np.lexsort((h, seen, part, level, owner))
    else:
        pack = lambda x, n: x.astype(np.uint64) << np.uint64(n)
        order = np.argsort(pack(owner, 52) | pack(level, 48) | pack(part, 36) | pack(np.minimum(seen, (1 << 20) - 1), 16) | h >> np.uint64(48), kind="stable")
    h, seen, owner, level, part = h[order], seen[order], owner[order], level[order], part[order]
    new = np.append(True, (owner[1:] != owner[:-1]) | (level[1:] != level[:-1]) | (part[1:] != part[:-1]))
    start = np.flatnonzero(new)
    return h, seen, np.cumsum(new) - 1, owner[start], level[start], np.diff(np.append(start, len(h)))


def keys_of(gram: np.ndarray, size: np.ndarray, table: np.ndarray, threshold: float, rare: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, text ordinal, least frequency of its tokens) of every key under which a text is looked for."""
    h, seen, group, owners, levels, length = ordered_tokens(gram, size, table)
    pos = np.arange(len(h)) - np.repeat(np.cumsum(length) - length, length)
    least = np.ceil(threshold * length - 1e-9).astype(np.int64)
    prefix = (length - least + 1)[group]
    token = np.where(levels[group] > 0, mix(h, 11) + levels[group].astype(np.uint64), h)
    single = np.flatnonzero((pos < prefix) & (seen > 1) & (seen <= rare))
    keys, owner, held = [token[single]], [owners[group[single]]], [seen[single]]
    kind = lambda n: np.searchsorted(SHARED, n, side="right") - 1
    # a partner is at least ``threshold`` times as large; both use the kind of the smaller one
    high, low = kind(least), kind(np.ceil(threshold * least - 1e-9).astype(np.int64).clip(1))
    for k, s in enumerate(SHARED):
        fits = ((low <= k) & (k <= high))[group]
        at = np.flatnonzero(fits & (pos < prefix + s - 1) & (seen > rare))
        if s == 1:
            keys.append(mix(token[at], 20))
            owner.append(owners[group[at]])
            held.append(seen[at])
            continue
        order = group[at] * (s - 1) + (mix(h[at], 3) % np.uint64(s - 1)).astype(np.int64)
        by = np.argsort(order, kind="stable")
        at, order = at[by], order[by]
        for far in range(1, len(at)):
            i = np.flatnonzero(order[:-far] == order[far:])
            if not len(i):
                break
            a, b = at[i], at[i + far]
            keys.append(mix(np.minimum(token[a], token[b]) * np.uint64(3) ^ np.maximum(token[a], token[b]), 20 + k))
            owner.append(owners[group[a]])
            held.append(np.minimum(seen[a], seen[b]))
    return np.concatenate(keys), np.concatenate(owner), np.concatenate(held)


def early_links(docs: DataFrame, table: np.ndarray, bands: int = 8, family: int = 32) -> DataFrame:
    """(a, b): the texts of a large family with its least text, where the first two tokens under each of
    two orders are the same; families of up to ``family`` texts are left to the full filter."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column(0).to_numpy(), b.column(1).to_pylist()
            for x, y in slices(texts):
                gram, size = trigrams(texts[x:y])
                h = mix(gram)
                seen = shared.value[(h % np.uint64(SLOTS)).astype(np.int64)]
                keep = np.flatnonzero(seen > family)  # what fewer texts hold is in no large family's prefix
                h, seen, owner = h[keep], seen[keep], np.repeat(np.arange(y - x), size)[keep]
                order = owner * (2 * bands) + (mix(h, 5) % np.uint64(2 * bands)).astype(np.int64)
                by = np.argsort(order.astype(np.uint64) << np.uint64(44) | np.minimum(seen, (1 << 20) - 1).astype(np.uint64) << np.uint64(24) | h >> np.uint64(40))
                h, order = h[by], order[by]
                start = np.flatnonzero(np.append(True, order[1:] != order[:-1])[: len(order)])
                two = start[np.append(order, -1)[start + 1] == order[start]]
                first = np.zeros((y - x) * 2 * bands, np.uint64)
                first[order[two]] = mix(h[two] * np.uint64(3) ^ h[two + 1], 6) | np.uint64(1)
                first = first.reshape(-1, bands, 2)
                doc, band = np.nonzero(first.all(axis=2))
                key = mix(first[doc, band, 0] * np.uint64(3) ^ first[doc, band, 1], 7) + band.astype(np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(ids[x:y][doc])], names=["key", "doc"])

    keys = stage(docs.select("doc", "letters").mapInArrow(rows, "key long, doc long"), "near-early")
    hubs = keys.groupBy("key").agg(F.min("doc").alias("a"), F.count(F.lit(1)).alias("n")).where(F.col("n") > family)
    return by_size(keys, hubs, ["key"], "n").where("a < doc").select("a", F.col("doc").alias("b")).distinct()


def large_keys(docs: DataFrame, table: np.ndarray, threshold: float, rare: int, block: int, most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Keys with more than ``block`` texts and their number of blocks, the ``most`` largest; all others
    hold at most a ``most``-th of all rows. Only keys whose tokens are frequent enough are counted."""
    none = np.empty(0, np.uint64), np.empty(0, np.int64)
    if table.max(initial=0) <= block:
        return none
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(0).to_pylist()
            for x, y in slices(texts, 1 << 18):
                gram, size = trigrams(texts[x:y])
                # only texts with a frequent token within the longest prefix have such keys
                owner = np.repeat(np.arange(y - x), size)
                rest = size - np.bincount(owner[shared.value[(mix(gram) % np.uint64(SLOTS)).astype(np.int64)] > block], minlength=y - x)
                own = (rest < size - np.ceil(threshold * size - 1e-9) + SHARED[-1]) | (size >= 2 * PART)
                gram, size = gram[own[owner]], size[own]
                if len(gram):
                    key, _, held = keys_of(gram, size, shared.value, threshold, rare)
                    key, n = np.unique(key[held > block], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["key", "n"])

    counted = docs.select("letters").mapInArrow(rows, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > block)
    out = counted.orderBy(F.desc("n"), "key").limit(most).toPandas().sort_values("key")
    key = out["key"].to_numpy().astype(np.int64).view(np.uint64)
    by = np.argsort(key)
    return key[by], -(-out["n"].to_numpy().astype(np.int64)[by] // block)


def signatures(docs: DataFrame, table: np.ndarray, large: tuple[np.ndarray, np.ndarray], parts: int, threshold: float, rare: int) -> DataFrame:
    """(part, doc, label, n, bits, keys): a text and its keys of one part of all keys.

    The last two bits of a key tell the side of a text where two blocks of a large key meet.
    """
    shared = docs.sparkSession.sparkContext.broadcast((table, *large))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, hot, blocks = shared.value
        for b in batches:
            ids, labels, texts = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_pylist()
            for x, y in slices(texts, 1 << 18):
                gram, size = trigrams(texts[x:y])
                if not len(gram):
                    continue
                bits = parity(gram, np.repeat(np.arange(y - x), size), y - x)
                key, owner, _ = keys_of(gram, size, table, threshold, rare)
                if not len(key):
                    continue
                side = np.zeros(len(key), np.uint64)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
                    cut = hot[at] == key
                    n = blocks[at[cut]]
                    own = (mix(ids[x:y][owner[cut]].view(np.uint64), 9) % n.astype(np.uint64)).astype(np.int64)
                    # a text goes to the meetings of its block with every block, its own included
                    k, o, own, size_ = (np.repeat(v, n) for v in (key[cut], owner[cut], own, n))
                    other = np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
                    low, high = np.minimum(own, other), np.maximum(own, other)
                    k = mix(k + (low * size_ + high).astype(np.uint64), 10)
                    key, owner = np.concatenate([key[~cut], k]), np.concatenate([owner[~cut], o])
                    side = np.concatenate([side[~cut], np.where(low == high, 0, 2 + (own == high)).astype(np.uint64)])
                part = (key % np.uint64(parts)).astype(np.int64)
                by = np.argsort(part * (y - x) + owner, kind="stable")
                part, owner = part[by], owner[by]
                short = ((key[by] >> np.uint64(32)) & np.uint64(0xFFFFFFFC) | side[by]).astype(np.uint32)
                start = np.flatnonzero(np.append(True, (part[1:] != part[:-1]) | (owner[1:] != owner[:-1])))
                part, owner = part[start], owner[start]
                packed = pa.Array.from_buffers(pa.binary(WORDS * 8), len(owner), [None, pa.py_buffer(np.ascontiguousarray(bits[owner]).tobytes())]).cast(pa.binary())
                offsets = pa.py_buffer((np.append(start, len(short)) * 4).astype(np.int32).tobytes())
                held = pa.Array.from_buffers(pa.binary(), len(start), [None, offsets, pa.py_buffer(short.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(ids[x:y][owner]), pa.array(labels[x:y][owner]), pa.array(size[owner].astype(np.int32)), packed, held], names=["part", "doc", "label", "n", "bits", "keys"])

    return docs.select("doc", "label", "letters").mapInArrow(rows, "part int, doc long, label long, n int, bits binary, keys binary")


def survivors(n: np.ndarray, bits: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs (i, j) sizes and bitmaps leave: similar sets differ in at most
    ``n1 + n2 - 2 overlap`` tokens, hence in no more bits."""
    total = n[i] + n[j]
    need = np.ceil(threshold / (1 + threshold) * total - 1e-9).astype(np.int64)
    apart = sum(np.bitwise_count(w[i] ^ w[j]).astype(np.int64) for w in bits)
    return (np.minimum(n[i], n[j]) >= need) & (apart <= total - 2 * need)


def meetings(key: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, beyond, end): the order by key and label, and for every place of it where the next
    label of its key begins and where its key ends."""
    order = np.argsort((key & np.uint32(0xFFFFFFFC)).astype(np.uint64) << np.uint64(32) | label.astype(np.uint64))
    key, label = key[order] & np.uint32(0xFFFFFFFC), label[order]
    new = np.append(True, key[1:] != key[:-1])
    edge = np.append(np.flatnonzero(new), len(key))
    run = np.append(np.flatnonzero(new | np.append(True, label[1:] != label[:-1])), len(key))
    return order, np.repeat(run[1:], np.diff(run)), np.repeat(edge[1:], np.diff(edge))


def near(bits: list[np.ndarray], most: np.ndarray, beyond: np.ndarray, end: np.ndarray, rows: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places that meet under a key and differ in no more bits than both of their bounds allow.

    Four words are read here, which rule most pairs out. Groups of one size and a label a place are
    stacked and compared by distance all at once; larger ones are taken in blocks of rows, and what is
    left place by place.
    """
    start = np.flatnonzero(np.append(True, end[1:] != end[:-1])[: len(end)])
    size = np.diff(np.append(start, len(end)))
    partners = end - beyond
    if len(start):
        simple = np.logical_and.reduceat(beyond == np.arange(1, len(end) + 1), start) & (size > 1) & (size <= STACKED)
        for g in np.unique(size[simple]).tolist():
            every = start[simple & (size == g)]
            for k in range(0, len(every), (1 << 19) // g):
                at = every[k : k + (1 << 19) // g, None] + np.arange(g)
                w, m = [b[at] for b in bits[:4]], most[at]
                small = m.max() < 120
                m = np.ceil(m).astype(np.uint8) if small else m
                for d in range(1, g):
                    apart = np.bitwise_count(w[0][:, :-d] ^ w[0][:, d:])
                    for x in w[1:]:
                        apart += np.bitwise_count(x[:, :-d] ^ x[:, d:])
                    i, j = np.nonzero(apart <= m[:, :-d] + m[:, d:])
                    yield at[i, j], at[i, j + d]
                partners[at] = 0
        size = np.where(simple, 0, size)
    for a, b in zip(start[size > DENSE].tolist(), (start + size)[size > DENSE].tolist()):
        partners[a:b] = 0
        small = most[a:b].max() < 120
        bound = np.ceil(most[a:b]).astype(np.uint8) if small else most[a:b]
        for x in range(a, b, rows):
            y, first = min(x + rows, b), int(beyond[x])
            if first >= b:  # the last label of the group: nothing follows
                break
            apart = np.zeros((y - x, b - first), np.uint8 if small else np.uint16)
            for w in bits[:4]:
                apart += np.bitwise_count(w[x:y, None] ^ w[None, first:b])
            i, j = np.nonzero(apart <= bound[x - a : y - a, None] + bound[None, first - a :])
            i, j = i + x, j + first
            later = j >= beyond[i]
            yield i[later], j[later]
    i, far = np.flatnonzero(partners), 0
    while len(i):
        j = beyond[i] + far
        apart = np.bitwise_count(bits[0][i] ^ bits[0][j]) + np.bitwise_count(bits[1][i] ^ bits[1][j])
        kept = np.flatnonzero(apart <= most[i] + most[j])
        x, y = i[kept], j[kept]
        apart = apart[kept] + np.bitwise_count(bits[2][x] ^ bits[2][y]) + np.bitwise_count(bits[3][x] ^ bits[3][y])
        kept = apart <= most[x] + most[y]
        yield x[kept], y[kept]
        far += 1
        i = i[partners[i] > far]


def compare(rows: DataFrame, parts: int, threshold: float) -> DataFrame:
    """(a, b): the pairs of texts of different labels that meet under a key and pass the filters."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        del held
        doc, label, n = (table.column(c).to_numpy() for c in ("doc", "label", "n"))
        bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(-1, WORDS)
        own = table.column("keys").to_pylist()
        key = np.frombuffer(b"".join(own), np.uint32)
        row = np.repeat(np.arange(len(doc), dtype=np.int32), [len(k) // 4 for k in own])
        del table, own
        order, beyond, end = meetings(key, np.unique(label, return_inverse=True)[1].astype(np.uint32)[row])
        row, side = row[order], (key[order] & np.uint32(3)).astype(np.int8)
        del key, order
        n = n.astype(np.int64)
        size = n[row]
        words = [np.ascontiguousarray(bits[:, w])[row] for w in range(WORDS)]
        found, total = [], 0

        def emit() -> pa.RecordBatch:
            code = np.unique(np.concatenate(found))
            x, y = doc[code >> 32], doc[code & 0xFFFFFFFF]
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

        for i, j in near(words, (size * ((1 - threshold) / (1 + threshold)) + 1e-6).astype(np.float32), beyond, end):
            apart = (side[i] == 0) | (side[i] != side[j])
            i, j = i[apart], j[apart]
            kept = survivors(size, words, i, j, threshold)
            x, y = row[i[kept]].astype(np.int64), row[j[kept]].astype(np.int64)
            found.append(np.minimum(x, y) << 32 | np.maximum(x, y))
            total += len(x)
            if total > PAIRS_AT_ONCE:
                yield emit()
                found, total = [], 0
        if total:
            yield emit()

    return rows.repartitionById(parts, F.col("part")).mapInArrow(pairs, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts reach the threshold."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                p, q = ({t[i : i + 3] for i in range(len(t) - 2)} for t in (x, y))
                keep.append(len(p & q) >= threshold * len(p | q) - 1e-9 and bool(p))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep))

    text = lambda c, t: docs.select(F.col("doc").alias(c), F.col("letters").alias(t))
    both = salted(pairs, text("a", "x")).join(text("b", "y"), "b")
    return both.select("a", "b", "x", "y").mapInArrow(rows, "a long, b long")


def salted(pairs: DataFrame, left: DataFrame, share: int = 1000, salt: int = 64) -> DataFrame:
    """``pairs`` (a stage table) joined to the texts of ``a``; the rows of an ``a`` that has more than a
    ``share``-th of all pairs (fewer than ``share`` can) go to ``salt`` tasks, its text to each of them."""
    counts = pairs.groupBy("a").count()
    n = pairs.count()
    hot = F.broadcast(counts.where(F.col("count") > max(share, n // share)).select("a", F.lit(salt).alias("cuts")))
    cut = pairs.join(hot, "a", "left").withColumn("salt", F.coalesce(F.expr("pmod(xxhash64(b), cuts)"), F.lit(0)).cast("int")).drop("cuts")
    wide = left.join(hot, "a", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("cuts", F.lit(1)) - 1))).drop("cuts")
    return cut.join(wide, ["a", "salt"]).drop("salt")


def merged_in_one(edges: DataFrame) -> DataFrame:
    """(node, label) of edges (u, v) of a checked number, by union and find in one task."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        u, v = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in (0, 1))
        node, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        u, v = at[: len(u)], at[len(u) :]
        root = np.arange(len(node))  # hooks the larger root below the smaller one, then halves all paths, until nothing changes
        while True:
            x, y = root[u], root[v]
            if (x == y).all():
                break
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (root[root] != root).any():
                root = root[root]
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(node[root])], names=["node", "label"])

    return edges.select("u", "v").coalesce(1).mapInArrow(rows, "node long, label long")


def components(edges: DataFrame, at_once: int = 1 << 20) -> DataFrame:
    """(node, label): the least node of its component, for every node of an edge (a, b).

    Rounds of large-star and small-star; what they have contracted to ``at_once`` edges of roots is merged in one task.
    """
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:  # every round reads a table and writes the next, which then is all that is needed
        state = now.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if state[0] <= at_once:
            return merged_in_one(now)
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = by_size(both, least, ["u"], "n").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stage(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = by_size(large, least, ["u"], "n").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        old, now = now, stage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        unstage(old, large)


def few(df: DataFrame, most: int = 1 << 20) -> DataFrame:
    """A slim table, to be broadcast if it has ``most`` rows at most (about 20 MB); counted, so give a stage table or one cheap to read."""
    return F.broadcast(df) if df.count() <= most else df


def near_found(df: DataFrame, id: str = "bank_id", body: str = "body", threshold: float = 0.6, rare: int = 128, block: int = 4096) -> DataFrame:
    """(first_id, other_id): every record of a group with its group's smallest id."""
    rows = stage(keyed(df, id, body, field_labels(df, body)), "near-keys")
    groups = stage(rows.groupBy("c1", "c2").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies")), "near-groups")
    # the records that another one of equal letters stands for; texts move only where these are too many to broadcast
    texts = groups.select(F.col("c1").alias("k1"), F.col("c2").alias("k2"), "first_id", "copies")
    own = rows.select("id", F.col("c1").alias("k1"), F.col("c2").alias("k2"))
    copies = stage(by_size(own, texts.where("copies > 1"), ["k1", "k2"], "copies").where("id <> first_id").select("first_id", "id", F.col("k1").alias("c1"), F.col("k2").alias("c2")), "near-copies")
    docs = rows.join(few(copies.select("id", "c1", "c2")), ["id", "c1", "c2"], "left_anti").select(F.col("id").alias("doc"), "letters")
    # texts that copies of problem 3 hold together
    held = rows.select("k1", "k2", "c1", "c2").distinct().join(groups.select("c1", "c2", "first_id"), ["c1", "c2"])
    known = held.groupBy("k1", "k2").agg(F.min("first_id").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    links = by_size(held, known, ["k1", "k2"], "n").select("a", F.col("first_id").alias("b")).where("a <> b")
    table = frequencies(docs)
    label = stage(components(verified(stage(early_links(docs, table), "near-hubs"), docs, threshold).unionByName(links)), "near-first")
    labelled = docs.join(few(label.select(F.col("node").alias("doc"), "label")), "doc", "left").select("doc", F.coalesce("label", "doc").alias("label"), "letters")
    parts = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil((docs.agg(F.sum(F.length("letters"))).first()[0] or 0) / KEYS_A_PART))
    large = large_keys(docs, table, threshold, rare, block)
    pairs = compare(signatures(labelled, table, large, parts, threshold, rare), parts, threshold)
    found = verified(stage(pairs.distinct(), "near-pairs"), docs, threshold)
    # what is found links whole components: only their labels go through another contraction
    base = lambda c: label.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label"))
    between = found.join(base("a"), "a", "left").join(base("b"), "b", "left").select(F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b"))
    merged = components(between).select(F.col("node").alias("label"), F.col("label").alias("last"))
    # the representatives themselves, and the copies each stands for
    every = groups.select("first_id", F.col("first_id").alias("id")).unionByName(copies.select("first_id", "id"))
    labelled_ids = every.join(label.select(F.col("node").alias("first_id"), "label"), "first_id", "left").select(F.coalesce("label", "first_id").alias("label"), "id")
    return labelled_ids.join(merged, "label", "left").select(F.coalesce("last", "label").alias("first_id"), F.col("id").alias("other_id")).where("first_id <> other_id").distinct()
