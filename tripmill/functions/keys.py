"""Surrogate keys, salted hashes of personal data, and spreading of hot keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_KEY = "-1"


def surrogate_key(*parts: Column) -> Column:
    """A stable 128-bit key of the business key, as 32 hex digits: the same on every run and executor."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("\\N")) for p in parts])
    return F.substring(F.sha2(text, 256), 1, 32)


def hashed(text: Column, salt: str) -> Column:
    """Salted SHA-256 of personal data; NULL stays NULL."""
    return F.sha2(F.concat(F.lit(salt), text), 256)


def date_key(date: Column) -> Column:
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def time_key(ts: Column) -> Column:
    return (F.hour(ts) * 100 + F.minute(ts)).cast("int")
