"""Aggregations of the archive; Spark combines all of them before their shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def multiplicity(df: DataFrame, key: Sequence[str], name: str = "n") -> DataFrame:
    """Rows with the number of rows of their key."""
    return df.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(*key)))


def last_wins(df: DataFrame, key: Sequence[str], order: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(key, fields, n): the fields of the last row of each key, and how many rows it had."""
    last = F.max_by(F.struct(*fields), F.struct(*order)).alias("x")
    return df.groupBy(*key).agg(last, F.count(F.lit(1)).alias("n")).select(*key, "x.*", "n")


def value_sets(df: DataFrame, key: Sequence[str], value: Column, name: str = "values") -> DataFrame:
    """(key, values): the distinct values of each key, sorted."""
    return df.groupBy(*key).agg(F.array_sort(F.collect_set(value)).alias(name))


def tally(df: DataFrame, group: Sequence[str], status: str, statuses: Sequence[str], id: str, closed: Sequence[str]) -> DataFrame:
    """(group, one count per status, total, open): counts per status and the sorted ids that are not closed."""
    counts = [F.count_if(F.col(status) == s).alias(s) for s in statuses]
    open_ = F.array_sort(F.collect_list(F.when(~F.col(status).isin(*closed), F.col(id)))).alias("open")
    return df.groupBy(*group).agg(*counts, F.count(F.lit(1)).alias("total"), open_)


def rolled_up(df: DataFrame, group: str, measures: dict[str, Column], total: str = "合计") -> DataFrame:
    """Measures per group and a grand total, in one pass."""
    out = df.rollup(group).agg(F.grouping_id().alias("_all"), *(c.alias(n) for n, c in measures.items()))
    return out.withColumn(group, F.when(F.col("_all") == 1, F.lit(total)).otherwise(F.col(group))).drop("_all")


def stages(df: DataFrame, group: Sequence[str], done: dict[str, Column]) -> DataFrame:
    """(group, papers, a count per stage, all_done): how many passed each stage, and all of them."""
    every = None
    for c in done.values():
        every = c if every is None else every & c
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("papers"), *(F.count_if(c).alias(n) for n, c in done.items()), F.count_if(every).alias("all_done"))


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, n): keys of more than one row."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def verdict(findings: DataFrame, group: Sequence[str]) -> DataFrame:
    """(group, errors, warnings, failed) of findings."""
    return findings.groupBy(*group).agg(F.count_if(F.col("level") == "error").alias("errors"), F.count_if(F.col("level") == "warning").alias("warnings"), F.max((F.col("level") == "error").cast("int")).alias("failed"))


def source_hash(*texts: Column) -> Column:
    """One SHA-256 of several texts with a zero byte between them."""
    parts: list[Column] = []
    for t in texts:
        parts += [F.coalesce(t, F.lit("")).cast("binary"), F.lit(b"\x00")]
    return F.sha2(F.concat(*parts[:-1]), 256)


#: The list whose items are counted, and lists that hide what they hold.
COUNTED, HIDING = "enumerate", ("steps", "itemize", "description")


def outer_items(text: Column) -> Column:
    r"""How many ``\item`` stand at the least depth of nested enumerations, none inside another list.

    The marks of a text are folded into the depths of its items; only those at the least depth count.
    Depth never falls below 0; items outside every enumeration do not count.
    """
    names = "|".join((COUNTED, *HIDING))
    marks = F.regexp_extract_all(text, F.lit(rf"\\(?:begin|end)\{{(?:{names})\}}|\\item(?![A-Za-z0-9_])"), F.lit(0))
    start = F.struct(F.lit(0).alias("hidden"), F.lit(0).alias("depth"), F.array().cast("array<int>").alias("items"))

    def fold(s: Column, m: Column) -> Column:
        step = F.when(m.startswith("\\begin"), 1).when(m.startswith("\\end"), -1).otherwise(0)
        moved = lambda level, here: F.greatest(level + F.when(here, step).otherwise(0), F.lit(0)).cast("int")
        own = m.endswith(f"{{{COUNTED}}}") & (s["hidden"] == 0)
        counts = (step == 0) & (s["hidden"] == 0) & (s["depth"] > 0)
        return F.struct(moved(s["hidden"], ~m.endswith(f"{{{COUNTED}}}")).alias("hidden"), moved(s["depth"], own).alias("depth"), F.when(counts, F.array_append(s["items"], s["depth"])).otherwise(s["items"]).alias("items"))

    least = lambda s: F.size(F.filter(s["items"], lambda d: d == F.array_min(s["items"])))
    return F.aggregate(F.coalesce(marks, F.array().cast("array<string>")), start, fold, least)
