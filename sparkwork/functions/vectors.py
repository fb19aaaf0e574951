"""Dense-vector column expressions over ``array<double>``.

Higher-order functions (``zip_with``, ``transform``, ``aggregate``) run in the JVM;
no Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def dot(a, b) -> Column:
    """Inner product <a, b>."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm_sq(a) -> Column:
    """<a, a>."""
    return F.aggregate(_c(a), F.lit(0.0), lambda acc, x: acc + x * x)


def scale(alpha, x) -> Column:
    """alpha * x."""
    al = _c(alpha)
    return F.transform(_c(x), lambda v: v * al)


def axpy(alpha, x, y) -> Column:
    """alpha * x + y."""
    al = _c(alpha)
    return F.zip_with(_c(x), _c(y), lambda a, b: al * a + b)


def add(x, y) -> Column:
    return F.zip_with(_c(x), _c(y), lambda a, b: a + b)


def subtract(x, y) -> Column:
    return F.zip_with(_c(x), _c(y), lambda a, b: a - b)


def _broadcast_scalar(value: Column, like: Column) -> Column:
    """An array repeating ``value`` to the length of ``like``: evaluated once per row, zipped in."""
    return F.array_repeat(value, F.size(like))


def softmax(x) -> Column:
    """exp(x - max x) / sum(exp(x - max x)); stable for large scores.

    No lambda refers to an expression outside itself: the row maximum and the row
    total are computed once per row and zipped in, so nothing is re-evaluated per
    element even when the optimizer inlines ``x``.
    """
    xs = _c(x)
    e = F.zip_with(xs, _broadcast_scalar(F.array_max(xs), xs), lambda v, m: F.exp(v - m))
    total = F.aggregate(e, F.lit(0.0), lambda acc, v: acc + v)
    return F.zip_with(e, _broadcast_scalar(total, e), lambda v, t: v / t)


def argmax(x) -> Column:
    """0-based position of the first largest element (as ``argmax`` does)."""
    xs = _c(x)
    return (F.array_position(xs, F.array_max(xs)) - F.lit(1)).cast("int")


def one_hot(label, n: int) -> Column:
    """``array<double>`` of length n with 1.0 at position ``label``."""
    lab = _c(label)
    return F.array(*[F.when(lab == k, F.lit(1.0)).otherwise(F.lit(0.0)) for k in range(n)])


def element(x, k: int) -> Column:
    """x[k] (0-based), NULL when out of range."""
    return F.get(_c(x), k)


def flatten_tensor(x) -> Column:
    """n-d nested arrays to one vector (e.g. an image's rows x columns x channels)."""
    xs = _c(x)
    return F.flatten(xs)
