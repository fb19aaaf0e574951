"""Parameter sweeps around any trainer (k-fold CV lives with each model: factorise, linear)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sweep(lams: Sequence[float], trainer: Callable[[float], DataFrame], col: str = "lam") -> DataFrame:
    """Run ``trainer(lam)`` for every value and stack the returned result tables with a ``lam`` column.

    Each run is its own set of Spark jobs over the whole data; only the small result
    tables (one row per iteration or fold) are stacked.
    """
    out = None
    for lam in lams:
        part = trainer(lam).withColumn(col, F.lit(float(lam)))
        out = part if out is None else out.unionByName(part)
    return out.select(col, *[c for c in out.columns if c != col])

