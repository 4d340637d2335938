"""Set operations over tokens and keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def tokens(df: DataFrame, text: str, pattern: str) -> DataFrame:
    """(token): the distinct matches of a pattern."""
    return df.select(F.explode(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(pattern), F.lit(0))).alias("token")).distinct()


def source_masks(sources: dict[str, DataFrame]) -> DataFrame:
    """(token, mask): which sources hold a token, bit 0 the first: all differences in one aggregation."""
    out = None
    for i, df in enumerate(sources.values()):
        part = df.select("token", F.lit(1 << i).alias("bit"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("token").agg(F.bit_or("bit").alias("mask"))


def material_report(df: DataFrame, key: list[str], engines: tuple[str, str, str], number: str = r"[0-9]+\.?[0-9]*", formula: str = r"\$[^$\n]+\$") -> DataFrame:
    """(key, source_hash, report): what each of three recognitions of one source has alone.

    ``df`` has the key and a text column per engine. Numbers are compared three ways, formulas of the
    first two engines two ways; the hash covers the first two texts.
    """
    from sheafline.functions.text import set_text
    from sheafline.operators.aggregates import source_hash

    found = lambda c, p: F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(c), F.lit("")), F.lit(p), F.lit(0)))
    numbers, formulas = [found(e, number) for e in engines], [found(e, formula) for e in engines[:2]]
    lines_ = [F.concat(F.lit(f"{e} alone: "), set_text(F.array_except(F.array_except(numbers[i], numbers[(i + 1) % 3]), numbers[(i + 2) % 3]))) for i, e in enumerate(engines)]
    lines_ += [F.concat(F.lit(f"{engines[i]} formulas: "), set_text(F.array_except(formulas[i], formulas[1 - i]))) for i in (0, 1)]
    return df.select(*key, source_hash(F.col(engines[0]), F.col(engines[1])).alias("source_hash"), F.concat_ws("\n", *lines_).alias("report"))


def only_in(masks: DataFrame, i: int) -> DataFrame:
    """Tokens of one source alone."""
    return masks.where(F.col("mask") == 1 << i).select("token")


def minus(a: DataFrame, *others: DataFrame, on: str) -> DataFrame:
    """Rows of ``a`` whose key is in none of the others."""
    for b in others:
        a = a.join(b.select(on).distinct(), on, "left_anti")
    return a


def distinct_in_order(values: Column) -> Column:
    """The distinct values of an array, in order of first appearance."""
    return F.array_distinct(values)


def share_a_value(a: Column, b: Column) -> Column:
    """Whether two arrays have a value in common."""
    return F.arrays_overlap(a, b)
