"""Truncated repetitions at the end of recognised text."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql import types as T


def collapse_tail(text: str, least: int = 8000, period: int = 200, times: int = 5, size: int = 100) -> str:
    """A long text whose end repeats a short unit keeps the unit once, and what was cut off of a last one.

    The unit has at most ``period`` characters, stands ``times`` at least and covers ``size`` at least.
    """
    if text is None or len(text) < least:
        return text
    n = len(text)
    for p in range(1, period + 1):
        k = n - 1
        while k >= p and text[k] == text[k - p]:
            k -= 1
        covered = n - 1 - k + p
        if covered >= max(times * p, size):
            return text[: n - covered + p] + text[n - covered % p :]
    return text


@F.pandas_udf(T.StringType())
def _collapse(texts: pd.Series) -> pd.Series:
    return texts.map(collapse_tail, na_action="ignore")


def tail_repeat(text: Column) -> Column:
    """The column form of ``collapse_tail``."""
    return _collapse(text)
