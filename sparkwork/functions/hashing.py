"""Deterministic hash-derived numbers: buckets, uniforms, normals.

All are md5-based built-in expressions, so a value depends only on the seed and the
key, never on partitioning or task order (unlike ``rand(seed)``/``randn(seed)``), and
an SQL engine with ``md5`` reproduces them exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def digest(*parts) -> Column:
    """md5 hex digest of the parts joined by ':' (numbers in their plain decimal form)."""
    return F.md5(F.concat_ws(":", *[_c(p).cast("string") for p in parts]))


def hex_to_long(hexcol: Column, start: int, length: int) -> Column:
    """Unsigned integer of ``length`` hex digits of ``hexcol`` from ``start`` (1-based)."""
    return F.conv(F.substring(hexcol, start, length), 16, 10).cast("bigint")


def bucket(k: int, *parts) -> Column:
    """Bucket in [0, k) from the first 32 bits of the digest of ``parts``."""
    return hex_to_long(digest(*parts), 1, 8) % F.lit(k)


def unit(*parts) -> Column:
    """Uniform number in [0, 1) from the first 32 bits of the digest."""
    return hex_to_long(digest(*parts), 1, 8) / F.lit(TWO_32)


def order_key(*parts) -> Column:
    """A 60-bit pseudo-random ordering key (bigint) from the digest."""
    return hex_to_long(digest(*parts), 1, 15)


def normal(*parts) -> Column:
    """Standard normal number by Box-Muller on two 32-bit pieces of the digest."""
    h = digest(*parts)
    u1 = (hex_to_long(h, 1, 8) + F.lit(1)) / F.lit(TWO_32 + 1.0)
    u2 = hex_to_long(h, 9, 8) / F.lit(TWO_32)
    return F.sqrt(F.lit(-2.0) * F.ln(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)
