"""The 64-bit string fingerprint that stored click models hash their categories with, as an Arrow function.

It is the public farm fingerprint: one mixing step for up to 16, 32 and 64 bytes each, and a loop over blocks of
64 bytes beyond. A batch is hashed once for each of its distinct texts.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

MASK = (1 << 64) - 1
# fixed values: the three odd constants of the fingerprint
K0, K1, K2 = 0xC3A5C85C97CB3127, 0xB492B66FBE98F273, 0x9AE16A3B2F90404F


def _turn(x: int, n: int) -> int:
    x &= MASK
    return (x >> n | x << 64 - n) & MASK


def _fold(x: int) -> int:
    return x ^ x >> 47


def _mix(u: int, v: int, mul: int) -> int:
    a = _fold((u ^ v) * mul & MASK)
    return _fold((v ^ a) * mul & MASK) * mul & MASK


class _Words:
    """Little-endian words of a text by byte offset; negative offsets count from the end."""

    def __init__(self, text: bytes):
        self.text, self.n = text, len(text)

    def __call__(self, at: int, size: int = 8) -> int:
        at = at if at >= 0 else self.n + at
        return int.from_bytes(self.text[at : at + size], "little")


def _short(s: _Words) -> int:
    n = s.n
    if n >= 8:
        mul, a, b = K2 + 2 * n, s(0) + K2 & MASK, s(-8)
        return _mix(_turn(b, 37) * mul + a & MASK, (_turn(a, 25) + b) * mul & MASK, mul)
    if n >= 4:
        return _mix(n + (s(0, 4) << 3), s(-4, 4), K2 + 2 * n)
    if n:
        y, z = s.text[0] + (s.text[n >> 1] << 8), n + (s.text[-1] << 2)
        return _fold((y * K2 ^ z * K0) & MASK) * K2 & MASK
    return K2


def _ends(s: _Words, first: int) -> tuple[int, int, int, int]:
    """The two sums that both middle lengths start from, and their first and last words."""
    mul = K2 + 2 * s.n
    a, b, c, d = s(0) * first & MASK, s(8), s(-8) * mul & MASK, s(-16) * K2 & MASK
    return _turn(a + b, 43) + _turn(c, 30) + d & MASK, a + _turn(b + K2, 18) + c & MASK, a, mul


def _middle(s: _Words) -> int:
    if s.n <= 32:
        u, v, _, mul = _ends(s, K1)
        return _mix(u, v, mul)
    y, v, a, mul = _ends(s, K2)
    z = _mix(y, v, mul)
    e, f = s(16) * mul & MASK, s(24)
    g, h = (y + s(-32)) * mul & MASK, (z + s(-24)) * mul & MASK
    return _mix(_turn(e + f, 43) + _turn(g, 30) + h & MASK, e + _turn(f + a, 18) + g & MASK, mul)


def _block(s: _Words, at: int, a: int, b: int) -> tuple[int, int]:
    """Four words and two seeds to two words."""
    w, x, y, z = (s(at + 8 * i) for i in range(4))
    a = a + w & MASK
    b = _turn(b + a + z, 21)
    first, a = a, a + x + y & MASK
    return a + z & MASK, b + _turn(a, 44) + first & MASK


def _long(s: _Words) -> int:
    x, y = 81, 81 * K1 + 113 & MASK
    z = _fold(y * K2 + 113 & MASK) * K2 & MASK
    x = x * K2 + s(0) & MASK
    v, w = (0, 0), (0, 0)

    def turn(at: int, mul: int, tail: bool) -> None:
        nonlocal x, y, z, v, w
        times = 9 if tail else 1
        x = _turn(x + y + v[0] + s(at + 8), 37) * mul & MASK
        y = _turn(y + v[1] + s(at + 48), 42) * mul & MASK
        x ^= w[1] * times & MASK
        y = y + v[0] * times + s(at + 40) & MASK
        z = _turn(z + w[0], 33) * mul & MASK
        v = _block(s, at, v[1] * mul & MASK, x + w[0])
        w = _block(s, at + 32, z + w[1], y + s(at + 16))
        z, x = x, z

    over = (s.n - 1) % 64
    for at in range(0, s.n - 1 - over, 64):
        turn(at, K1, False)
    mul = K1 + (z & 255) * 2
    w = w[0] + over & MASK, w[1]
    v = v[0] + w[0] & MASK, v[1]
    w = w[0] + v[0] & MASK, w[1]
    turn(s.n - 64, mul, True)
    return _mix(_mix(v[0], w[0], mul) + _fold(y) * K0 + z & MASK, _mix(v[1], w[1], mul) + x & MASK, mul)


def fingerprint64(text: bytes) -> int:
    """Unsigned 64-bit fingerprint of a text's bytes."""
    s = _Words(text)
    return _short(s) if s.n <= 16 else _middle(s) if s.n <= 64 else _long(s)


def fingerprint_bucket(c: Column, buckets: int) -> Column:
    """Fingerprint of the text form, modulo ``buckets``; null stays null."""

    @F.arrow_udf("bigint")
    def run(v: pa.Array) -> pa.Array:
        coded = v.dictionary_encode()
        found = [None if t is None else fingerprint64(t.encode()) % buckets for t in coded.dictionary.to_pylist()]
        return pa.array(found, pa.int64()).take(coded.indices)

    return run(c.cast("string"))
