"""Problem 3: collapse records that differ only in formatting, and count their copies.

Method: every body is reduced to a 128-bit key of its letters and digits (for labelled records:
of its sorted fields). Each partition sets two Bloom filters, keys seen once and keys seen
repeatedly; merging two partitions ORs both and adds to the second what both saw once. A key
that occurs twice anywhere therefore has all its bits in the merged second filter, so only rows
that pass it are shuffled for exact grouping; all others are singletons and never move.

Scale: filters travel as compressed blocks, the merge streams block by block, and a merged
filter is broadcast under a fixed bound (``most_bits``). Beyond the bound the keys (not the texts)
are written in shards by their first bits and each shard gets a filter of its own, so that a filter
never fills up; at ten billion rows these are some 450 passes over a 450th of the keys each.
Grouping pre-aggregates before its shuffle.
Groups of more than a thousandth of the rows (of which there are under a thousand) are joined
to their members by broadcast, so that no task holds a hot group.

Defined results: a null body is never a copy of anything; bodies without any letter or digit
are copies of each other; rows that repeat an id count as copies but are not listed against
themselves; all other columns are disregarded, whatever their names.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from sheafline.llm.letters import FieldParser
from sheafline.session import spread, stage

HASHES = 4
BLOCK_BITS = 1 << 19
#: Keys of a partition that go into one pair of filters before it is handed on.
CHUNK = 1 << 21


def field_labels(df: DataFrame, body: str = "body", share: float = 0.001) -> tuple[str, ...]:
    """The labels of labelled fields, learnt from all bodies that begin in a notation that nothing else
    has (``【label】``, or a JSON object), for reading every other notation.

    A label stands in ``share`` of those bodies at least, so a thousand times as many labels as a
    body has can exist.
    """
    text = F.ltrim(F.col(body).cast("string"))
    names = F.when(text.startswith("【"), F.regexp_extract_all(text, F.lit(r"【\s*(\p{L}{1,12})\s*】"), F.lit(1))).when(text.startswith("{"), F.regexp_extract_all(text, F.lit(r'"\s*(\p{L}{1,12})\s*"\s*[:：]'), F.lit(1)))
    held = df.select(F.array_distinct(names).alias("names")).where("size(names) > 1")
    counts = held.select(F.explode(F.concat(F.array(F.lit("")), "names")).alias("label")).groupBy("label").count()
    total = counts.agg(F.max(F.when(F.col("label") == "", F.col("count")))).first()[0] or 0
    return tuple(sorted(r.label for r in counts.where((F.col("label") != "") & (F.col("count") >= share * total)).select("label").toLocalIterator()))


def keyed(df: DataFrame, id: str, body: str, labels: tuple[str, ...]) -> DataFrame:
    """(id, k1, k2): the two halves of the copy key, null for a null body."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = FieldParser(labels).key
        for b in batches:
            raw = [None if t is None else key(t) for t in b.column(1).to_pylist()]
            both = np.frombuffer(b"".join(x or bytes(16) for x in raw), "<i8").reshape(-1, 2)
            null = np.array([x is None for x in raw], bool)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(both[:, 0], mask=null), pa.array(both[:, 1], mask=null)], names=["id", "k1", "k2"])

    slim = spread(df.select(F.col(id).alias("id"), F.col(body).cast("string").alias("body")))
    return slim.mapInArrow(rows, T.StructType([T.StructField("id", slim.schema["id"].dataType), T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType())]))


def positions(k1: np.ndarray, k2: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each key, one row a hash function."""
    a, b = k1.view(np.uint64), k2.view(np.uint64) | np.uint64(1)
    return np.stack([((a + np.uint64(i) * b) >> np.uint64(7)) & np.uint64(bits - 1) for i in range(HASHES)])


def repeat_filter(keys: DataFrame, bits: int) -> np.ndarray:
    """The merged filter of keys seen repeatedly, as packed bits."""
    width = min(bits, BLOCK_BITS)

    def pack(own: np.ndarray) -> bytes:
        flags = np.zeros(width, np.uint8)
        flags[own % width] = 1
        return zlib.compress(np.packbits(flags).tobytes(), 1)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def emit() -> pa.RecordBatch:
            at, count = np.unique(np.concatenate(held), return_counts=True)
            block = at // width
            edges = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(at))
            parts = [(int(block[a]), pack(at[a:b]), pack(at[a:b][count[a:b] > 1])) for a, b in zip(edges, edges[1:])]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*parts)], names=["block", "once", "again"])

        for b in batches:
            if b.num_rows:
                held.append(positions(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False), bits).astype(np.int64).ravel())
                n += b.num_rows
            if n >= CHUNK:
                yield emit()
                held, n = [], 0
        if held:
            yield emit()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, once, again = None, None, None
        read = lambda x: np.frombuffer(zlib.decompress(x), np.uint8)
        row = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([again.tobytes()], pa.binary())], names=["block", "again"])
        for b in batches:
            for block, o, a in zip(*(b.column(i).to_pylist() for i in range(3))):
                o, a = read(o), read(a)
                if block == now:
                    again = again | a | (once & o)
                    once = once | o
                else:
                    if now is not None:
                        yield row()
                    now, once, again = block, o, a
        if now is not None:
            yield row()

    parts = keys.mapInArrow(build, "block long, once binary, again binary")
    merged = parts.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block long, again binary")
    out = np.zeros(bits // 8, np.uint8)
    for r in merged.toLocalIterator():  # at most bits / BLOCK_BITS rows, together bits / 8 bytes
        out[r.block * width // 8 : (r.block + 1) * width // 8] = np.frombuffer(r.again, np.uint8)
    return out


def find_copies(df: DataFrame, id: str = "bank_id", body: str = "body", bits_per_row: int = 12, most_bits: int = 1 << 28, labels: tuple[str, ...] | None = None) -> tuple[DataFrame, DataFrame]:
    """Groups (k1, k2, first_id, copies) of at least two rows, and all rows (id, k1, k2, maybe).

    Keys are cut into shards by their first bits, so that every filter has ``bits_per_row`` bits a row
    and at most ``most_bits``; the shards are taken one after the other, each with a filter of its own.
    """
    spark = df.sparkSession
    n = df.count()
    shards = max(1, -(-bits_per_row * n // most_bits))
    bits = min(1 << max(16, (bits_per_row * -(-n // shards) - 1).bit_length()), most_bits)
    keys = keyed(df, id, body, field_labels(df, body) if labels is None else labels)
    # null bodies are copies of nothing and go to the first shard
    keys = stage(keys.withColumn("shard", F.coalesce(F.expr(f"cast(pmod(shiftright(k1, 20), {shards}) as int)"), F.lit(0))), "copy-keys", by=("shard",) if shards > 1 else ())

    def probed(own: DataFrame) -> DataFrame:
        own = own.select("id", "k1", "k2")
        shared = spark.sparkContext.broadcast(repeat_filter(own.where("k1 is not null").select("k1", "k2"), bits).tobytes())

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = np.frombuffer(shared.value, np.uint8)
            for b in batches:
                null = b.column(1).is_null().to_numpy(zero_copy_only=False)
                k1, k2 = (b.column(i).fill_null(0).to_numpy(zero_copy_only=False) for i in (1, 2))
                at = positions(k1, k2, bits).astype(np.int64)
                seen = ((table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0) & ~null
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(seen)], names=["id", "k1", "k2", "maybe"])

        out = own.mapInArrow(probe, T.StructType([*own.schema.fields, T.StructField("maybe", T.BooleanType())]))
        if shards > 1:  # written before the next shard's filter takes the place of this one
            out = stage(out, "copy-rows")
            shared.destroy()
        return out

    rows = functools.reduce(DataFrame.unionByName, (probed(keys.where(F.col("shard") == k)) for k in range(shards)))
    groups = rows.where("maybe").groupBy("k1", "k2").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    return stage(groups, "copy-groups"), rows


def by_size(rows: DataFrame, groups: DataFrame, key: list[str], size: str, share: int = 1000) -> DataFrame:
    """``rows`` joined to their groups (key, .., size: the number of rows), so that no task holds a hot group.

    Groups of more than a ``share``-th of all rows, of which fewer than ``share`` can exist, are
    broadcast; their rows never move.
    """
    most = F.greatest(F.lit(share), F.floor(F.lit((groups.agg(F.sum(size)).first()[0] or 0) / share)))
    large = F.broadcast(groups.where(F.col(size) > most))
    hot = rows.join(large, key)
    cold = rows.join(large.select(*key), key, "left_anti").join(groups.where(F.col(size) <= most), key)
    return hot.unionByName(cold)


def members(groups: DataFrame, rows: DataFrame) -> DataFrame:
    """(first_id, id, copies) of every row in a group of at least two."""
    return by_size(rows.where("maybe").drop("maybe"), groups.where("copies > 1"), ["k1", "k2"], "copies").select("first_id", "id", "copies")


def copies_found(df: DataFrame, id: str = "bank_id", body: str = "body", **options) -> DataFrame:
    """(first_id, other_id): every copy that is not the smallest id of its group."""
    groups, rows = find_copies(df, id, body, **options)
    return members(groups, rows).where("id <> first_id").select("first_id", F.col("id").alias("other_id")).distinct()


def collapse(df: DataFrame, id: str = "bank_id", body: str = "body", **options) -> DataFrame:
    """(id, copies, duplicateId): one row per distinct body, the smallest id kept, with its number of copies;
    ``duplicateId`` names the kept record as it would stand in each of its copies."""
    groups, rows = find_copies(df, id, body, **options)
    single = rows.where("not maybe").select("id", F.lit(1).cast("long").alias("copies"))
    return single.unionByName(groups.select(F.col("first_id").alias("id"), "copies")).withColumn("duplicateId", F.col("id")).withColumnRenamed("id", id)
