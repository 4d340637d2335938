"""Text fields of a record as rows of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

FIELDS = ("body", "answer", "memo")


def long_fields(df: DataFrame, id: str, fields: tuple[str, ...] = FIELDS, keep: Column | None = None) -> DataFrame:
    """(id, field, text): one row per field that is not null; ``keep`` is a condition on ``text``."""
    one = [F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("text")) for f in fields]
    rows = df.select(F.col(id).alias("id"), F.explode(F.array(*one)).alias("x")).select("id", "x.field", "x.text").where("text is not null")
    return rows if keep is None else rows.where(keep)
