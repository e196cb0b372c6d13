"""Stable keyed draws and keyed sampling."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def stable_unit(*parts: Column) -> Column:
    """Deterministic value in [0, 1): first 12 hex digits of sha256 of the joined parts."""
    digest = F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(16 ** 12))


def in_sample(fraction: float, *parts: Column) -> Column:
    """Keep whole groups that share ``parts``: hashed bucket in 0..999 below the fraction.

    ``pmod`` keeps the minimum integer hash valid where ``abs`` would overflow.
    """
    bucket = F.pmod(F.hash(F.concat_ws("|", *parts)), F.lit(1000))
    return bucket < int(fraction * 1000)


def in_sample_md5(fraction: float, *parts: Column) -> Column:
    """Same grouping rule on an md5 bucket, reproducible outside Spark."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 1000
    return bucket < int(fraction * 1000)
