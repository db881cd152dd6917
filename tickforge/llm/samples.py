"""Bounded, repeatable samples of rows for fitting models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAIN = 1_000_000


def hashed_share(key: Column, rows: int, most: int) -> Column:
    """True for about ``most`` of ``rows`` rows, chosen by a hash of ``key``; for all of them if there are fewer."""
    if rows <= most:
        return F.lit(True)
    return F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(GRAIN)) < int(GRAIN * most / rows)


def id_bucket(key: Column, buckets: int) -> Column:
    """crc32 of the identifier as text, modulo ``buckets``; null for a null identifier."""
    return F.pmod(F.crc32(key.cast("string")), F.lit(buckets))


def sample_rows(rows: DataFrame, key: str, most: int) -> DataFrame:
    """About ``most`` rows at most."""
    return rows.where(hashed_share(F.col(key), rows.count(), most))
