"""Ranking inside groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def ranked(df: DataFrame, by: list[str], order: list[Column], out: str) -> DataFrame:
    """Dense 1..n position inside a group whose size the catalogue bounds (rails, candidates)."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def top_per_group(df: DataFrame, by: list[str], order: list[Column], k: int, out: str) -> DataFrame:
    """First ``k`` rows per group. Spark applies the rank limit before the shuffle, so a group
    of any size sends at most ``k`` rows per map task."""
    return ranked(df, by, order, out).where(F.col(out) <= k)

