"""Small scalar expressions used by heads, metrics and encoders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(x: Column) -> Column:
    """Stable on both tails: never exponentiates a positive number."""
    e = F.exp(-F.abs(x))
    return F.when(x >= 0, 1.0 / (1.0 + e)).otherwise(e / (1.0 + e))


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def log_loss_term(y: Column, p: Column, eps: float = 1e-15) -> Column:
    q = clip(p, eps, 1.0 - eps)
    return -(y * F.log(q) + (1.0 - y) * F.log(1.0 - q))


def rounded(x: Column, digits: int = 6) -> Column:
    """Fixed decimals, with negative zero folded into zero."""
    return F.round(x, digits) + F.lit(0.0)


def rounded_apart(x: Column, digits: int = 6) -> Column:
    """``rounded`` of a double without a decimal object a value; the few near a tie, and large ones, still take that way."""
    scale = float(10**digits)
    y = F.abs(x) * scale
    plain = (F.abs(x) < 1e6) & (F.abs(y - F.floor(y) - 0.5) > 1e-3)
    return F.when(plain, F.signum(x) * (F.floor(y + 0.5) / scale)).otherwise(F.round(x, digits)) + F.lit(0.0)


def hash_bucket(x: Column, n: int, kind: str = "xxhash64") -> Column:
    """Bucket of the text form: by Spark's own hash, by digits of its md5 (any SQL engine can repeat it), or by the
    fingerprint that stored click models use."""
    text = x.cast("string")
    if kind == "xxhash64":
        return F.pmod(F.xxhash64(text), F.lit(n)).cast("bigint")
    if kind == "md5":
        return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint"), F.lit(n)).cast("bigint")
    if kind == "fingerprint":
        from clickweave.functions.fingerprint import fingerprint_bucket

        return fingerprint_bucket(text, n)
    raise ValueError(f"unknown hash {kind}")
