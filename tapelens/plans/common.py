"""Rounding shared by queries: doubles are compared to six places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
