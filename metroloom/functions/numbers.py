"""Rounding with the semantics the results need (F24) and fixed-width text."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def half_up(x: Column) -> Column:
    """Nearest integer, halves towards plus infinity."""
    return F.floor(x + F.lit(0.5)).cast("bigint")


@F.pandas_udf(T.DoubleType())
def _exact(values: pd.Series, digits: pd.Series) -> pd.Series:
    def one(v: float, d: int) -> float | None:
        return None if v is None or pd.isna(v) else float(Decimal(v).quantize(Decimal(1).scaleb(-int(d)), ROUND_HALF_UP))

    return pd.Series([one(v, d) for v, d in zip(values, digits, strict=True)], dtype="float64")


def to_fixed(x: Column, digits: int) -> Column:
    """Rounds the exact binary value (1.005 at two digits is 1.0); for small outputs, since it runs in Python."""
    return _exact(x.cast("double"), F.lit(digits))


def pad(x: Column, width: int, right: bool = False) -> Column:
    """Fixed-width report text: padded, never cut."""
    text = x.cast("string")
    fill = F.repeat(F.lit(" "), F.greatest(F.lit(width) - F.length(text), F.lit(0)))
    return F.concat(fill, text) if right else F.concat(text, fill)
