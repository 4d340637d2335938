"""Upserts and incremental work: new snapshots are computed and written whole, never changed in place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sheafline import schema

LEDGER_KEY = ("year", "region", "question", "category", "problem")


def merge_ledger(ledger: DataFrame, reviews: DataFrame, key: Sequence[str] = LEDGER_KEY, order: Sequence[str] = ("seq",), sections: Sequence[Sequence[str]] = schema.SECTIONS) -> DataFrame:
    """(key, action, status, change, section): the ledger after reviews.

    Both sides have the key, action and status, and the order columns. The last row of a key in
    its side counts; reviews win, their null action leaves the old one. ``change`` is kept, updated,
    moved (to another section) or added; ``section`` ranks the status, unknown ones first.
    """

    def last(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(*key).agg(F.max_by(F.struct("action", "status"), F.struct(*order)).alias(side))

    both = last(ledger, "old").join(last(reviews, "new"), list(key), "full_outer")
    action, status = F.coalesce("new.action", "old.action"), F.coalesce("new.status", "old.status")
    change = (
        F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "kept").when(~status.eqNullSafe(F.col("old.status")), "moved").when(~action.eqNullSafe(F.col("old.action")), "updated").otherwise("kept")
    )
    place = lambda s: F.coalesce(*(F.when(s.isin(*own), i) for i, own in enumerate(sections, 1)), F.lit(0))
    old, new = place(F.col("old.status")), place(status)
    change = F.when((change == "moved") & (old == new), "updated").otherwise(change)
    return both.select(*key, action.alias("action"), status.alias("status"), change.alias("change"), new.cast("int").alias("section"))


def append_or_update(table: DataFrame, rows: DataFrame, key: Sequence[str], fields: Sequence[str], order: str) -> DataFrame:
    """A table without sections: rows of a known key overwrite, all others are appended, repeats included.

    ``order`` numbers the rows of either side; appended rows follow the table's.
    """
    known = rows.join(table.select(*key).distinct(), list(key), "left_semi")
    new = rows.join(table.select(*key).distinct(), list(key), "left_anti")
    last = known.groupBy(*key).agg(F.max_by(F.struct(*fields), order).alias("x"))
    updated = table.join(last, list(key), "left").select(*key, *(F.coalesce(F.col(f"x.{f}"), F.col(f)).alias(f) for f in fields), order, F.lit(0).alias("part"))
    return updated.unionByName(new.select(*key, *fields, order, F.lit(1).alias("part")))


def backfill(table: DataFrame, derived: DataFrame, key: Sequence[str], field: str) -> DataFrame:
    """A table with one column replaced by derived values where there are any."""
    side = derived.select(*key, F.col(field).cast(table.schema[field].dataType).alias("_new"))
    return table.join(side, list(key), "left").withColumn(field, F.coalesce("_new", field)).drop("_new")


def replace_block(text: Column, start: str, end: str, new: Column) -> Column:
    """A text with what stands between two marker lines replaced; without markers it stays as it is."""
    a, b = F.locate(start, text), F.locate(end, text)
    head = F.substring(text, F.lit(1), a + len(start) - 1)
    return F.when((a > 0) & (b > a), F.concat(head, F.lit("\n"), new, F.lit("\n"), F.substring(text, b, F.length(text)))).otherwise(text)


def pending(work: DataFrame, done: DataFrame, key: Sequence[str], force: bool = False) -> DataFrame:
    """Work whose output does not exist yet or is empty; all of it when forced. ``done`` has the key and ``length``."""
    return work if force else work.join(done.where("length > 0").select(*key).distinct(), list(key), "left_anti")


def by_hash(current: DataFrame, stored: DataFrame, key: Sequence[str], hash: str = "hash") -> DataFrame:
    """(key, hash, state): new, same, or drift (another source than the stored output was made of)."""
    old = stored.groupBy(*key).agg(F.max(hash).alias("_old"))
    state = F.when(F.col("_old").isNull(), "new").when(F.col("_old") == F.col(hash), "same").otherwise("drift")
    return current.join(old, list(key), "left").withColumn("state", state).drop("_old")


def changed_only(df: DataFrame, changes: DataFrame, on: str = "path") -> DataFrame:
    """Rows of the files in a list of changes."""
    return df.join(changes.select(on).distinct(), on, "left_semi")


def overlay(*configs: dict) -> dict:
    """Nested settings, later ones over earlier ones, key by key."""
    out: dict = {}
    for c in configs:
        for k, v in c.items():
            out[k] = overlay(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def latest(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key."""
    w = Window.partitionBy(*key).orderBy(*(F.col(c).desc_nulls_last() for c in order))
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
