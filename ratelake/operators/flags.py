"""Membership flags over text-valued measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratelake.functions.casts import lenient_float


def top_n_flag(rank_text: Column | str, low: float = 1, high: float = 3) -> Column:
    """1 when the text reads as a number within ``[low, high]``, else 0 (NULL → 0)."""
    c = F.col(rank_text) if isinstance(rank_text, str) else rank_text
    return F.when(lenient_float(c).between(low, high), F.lit(1)).otherwise(F.lit(0))
