"""Queries of the text-corpus problems, each over its whole tables, and SQL where it can say the same."""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sheafline.llm.copies import collapse, copies_found
from sheafline.llm.leaks import leaks_found
from sheafline.llm.lookalikes import unify_fields
from sheafline.llm.markup import clean_fields
from sheafline.llm.neardup import near_found
from sheafline.llm.pairs import defects_found
from sheafline.llm.personal import personal_found, redact
from sheafline.llm.tokens import encode_corpus
from sheafline.session import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every field of items that holds markup."""
    return clean_fields(table(spark, folder, "items"), only_cases=True).select("item_id", "field")


def p1_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """Every field of items as clean text with its structure kept."""
    return clean_fields(table(spark, folder, "items")).select("item_id", "field", "text")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every field of items that holds characters standing in for the usual ones."""
    return unify_fields(table(spark, folder, "items"), only_cases=True).select("item_id", "field")


def p2_unified(spark: SparkSession, folder: str) -> DataFrame:
    """Every field of items in the one form."""
    return unify_fields(table(spark, folder, "items")).select("item_id", "field", "text")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every record that copies another body in other formatting, with the record that is kept."""
    return copies_found(table(spark, folder, "bank_items"))


def p3_collapsed(spark: SparkSession, folder: str) -> DataFrame:
    """One record per distinct body and the number of its copies."""
    return collapse(table(spark, folder, "bank_items"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of a group of near-duplicates with the smallest id of the group."""
    return near_found(table(spark, folder, "bank_items"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every answer and memo that fails to respond to its body, with the defect."""
    return defects_found(table(spark, folder, "items"))


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document under the 50k byte-level vocabulary."""
    return encode_corpus(table(spark, folder, "documents"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every document and the test items of which it holds a passage."""
    return leaks_found(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p8_overlap(spark: SparkSession, folder: str) -> DataFrame:
    """The same pairs with the longest run of the question and whether the answer stands there too."""
    return leaks_found(table(spark, folder, "documents"), table(spark, folder, "eval_items"), answer="answer")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every distinct mention of personal information in a document."""
    return personal_found(table(spark, folder, "documents"))


def p9_redacted(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with typed placeholders in place of the mentions.

    The key of the surrogates is the session's ``spark.sheafline.key``; without one it is drawn for this run.
    """
    return redact(table(spark, folder, "documents"), spark.conf.get("spark.sheafline.key", None) or secrets.token_hex(32))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_cleaned": p1_cleaned,
    "p2_found": p2_found,
    "p2_unified": p2_unified,
    "p3_found": p3_found,
    "p3_collapsed": p3_collapsed,
    "p5_found": p5_found,
    "p6_found": p6_found,
    "p7_ids": p7_ids,
    "p8_found": p8_found,
    "p8_overlap": p8_overlap,
    "p9_found": p9_found,
    "p9_redacted": p9_redacted,
}
SQL: dict[str, str] = {}
