"""Operators that depend on the order of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def gaps(df: DataFrame, key: Sequence[str], number: str, at_once: int = 10_000) -> DataFrame:
    """(key, missing): numbers from 1 to the largest of each key that do not occur.

    Each number that is there is looked at with the one after it; what lies between is cut into
    ranges of ``at_once`` before it is written out, so one number far off fills no single row.
    """
    have = df.where(F.col(number) >= 1).select(*key, F.col(number).cast("long").alias("_n")).distinct()
    before = F.coalesce(F.lag("_n").over(Window.partitionBy(*key).orderBy("_n")), F.lit(0).cast("long"))
    step = F.lit(at_once).cast("long")
    holes = have.withColumn("_a", before + 1).where(F.col("_a") < F.col("_n")).withColumn("_a", F.explode(F.sequence("_a", F.col("_n") - 1, step)))
    return holes.select(*key, F.explode(F.sequence("_a", F.least(F.col("_a") + step, "_n") - 1)).alias("missing"))


def previous(df: DataFrame, key: Sequence[str], order: Sequence[str], value: str, name: str = "previous") -> DataFrame:
    """Rows with the value of the row before."""
    return df.withColumn(name, F.lag(value).over(Window.partitionBy(*key).orderBy(*order)))


def out_of_order(df: DataFrame, key: Sequence[str], order: Sequence[str], status: str, sequence: Sequence[str]) -> DataFrame:
    """Rows whose status ranks before that of the row ahead of them; unknown statuses have no rank."""
    rank = F.array_position(F.array(*map(F.lit, sequence)), F.col(status))
    known = df.withColumn("rank", F.nullif(rank, F.lit(0))).where("rank is not null")
    return previous(known, key, order, "rank", "before").where("rank < before").drop("rank", "before")


def key_sequence(df: DataFrame, key: Sequence[str], order: str, value: str, name: str = "keys") -> DataFrame:
    """(key, keys): the values of each key in order, as a list."""
    return df.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]).alias(name))


def renumber(df: DataFrame, key: Sequence[str], order: Sequence[str], name: str = "new_number") -> DataFrame:
    """Rows numbered from 1 within their key."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order)))


def first_seen(df: DataFrame, key: Sequence[str], pos: str, value: str) -> DataFrame:
    """(key, value, no, code): distinct values in order of first appearance; ``code`` is ``01``, or ``01a``, ``01b`` .. of several."""
    seen = df.groupBy(*key, value).agg(F.min(pos).alias("_at"))
    w = Window.partitionBy(*key)
    out = seen.withColumn("no", F.row_number().over(w.orderBy("_at", value))).withColumn("_n", F.count(F.lit(1)).over(w))
    head = F.lpad(F.col(key[-1]).cast("string"), 2, "0")
    return out.withColumn("code", F.when(F.col("_n") == 1, head).otherwise(F.concat(head, F.chr((F.col("no") + 96).cast("long"))))).drop("_at", "_n")


def carry_forward(df: DataFrame, key: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Rows with the last value seen so far that is not null."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def islands(df: DataFrame, key: Sequence[str], order: Sequence[str], same: str) -> DataFrame:
    """Rows with ``island``: a number that grows where the value differs from that of the row before."""
    w = Window.partitionBy(*key).orderBy(*order)
    starts = (~F.col(same).eqNullSafe(F.lag(same).over(w)) | (F.row_number().over(w) == 1)).cast("int")
    return df.withColumn("_s", starts).withColumn("island", F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_s")


def merge_tables(pages: DataFrame, key: Sequence[str], page: str, html: str) -> DataFrame:
    """(key, page, html): pages joined where one ends with a table and the next begins with one.

    The end tag of the first and the whole start tag of the second go.
    """
    w = Window.partitionBy(*key).orderBy(page)
    opens, ends = F.trim(html).rlike(r"(?is)^<table\b"), F.lag(F.trim(html).rlike(r"(?is)</table>$")).over(w)
    marked = pages.withColumn("_j", F.coalesce(opens & ends, F.lit(False)))
    marked = marked.withColumn("_i", F.sum((~F.col("_j")).cast("int")).over(w)).withColumn("_n", F.coalesce(F.lead("_j").over(w), F.lit(False)))
    text = F.when(F.col("_j"), F.regexp_replace(F.trim(html), r"(?is)^<table\b[^>]*>", "")).otherwise(F.col(html))
    text = F.when(F.col("_n"), F.regexp_replace(F.rtrim(text), r"(?is)</table>$", "")).otherwise(text)
    parts = F.transform(F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), text.alias("t")))), lambda x: x["t"])
    return marked.groupBy(*key, "_i").agg(F.min(page).alias(page), F.array_join(parts, "").alias(html)).drop("_i")


def running_depth(df: DataFrame, key: Sequence[str], order: Sequence[str], step: Column, name: str = "depth") -> DataFrame:
    """Rows with the running sum of +1 and -1 steps."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(step).over(w))


def year_rank(year: Column) -> Column:
    """Sort key of year titles: spans before a year first, then plain years ascending, unknown last."""
    before = F.coalesce(year.endswith("以前"), F.lit(False))
    n = F.when(before, F.coalesce(F.nullif(F.regexp_extract(year, "^([0-9]{4})", 1), F.lit("")).try_cast("int"), F.lit(0))).otherwise(F.coalesce(F.when(year.rlike("^[0-9]+$"), year.try_cast("int")), F.lit(9999)))
    return F.struct(F.when(before, 0).otherwise(1).alias("bucket"), n.alias("n"))


def top_by(df: DataFrame, key: Sequence[str], score: Column, order: Column) -> DataFrame:
    """One row per key: the greatest score, the first in order among equals."""
    cols = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*cols), F.struct(score, -order)).alias("x")).select(*key, "x.*")


def first_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first rows in an order: the feature of a work list with a limit."""
    return df.orderBy(*order).limit(n)
