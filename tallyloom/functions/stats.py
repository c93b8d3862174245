"""Aggregate expressions over value histograms ``(value, n)``.

A histogram is built by ``groupBy(value).count()``, which combines on the map side; so a percentile never gathers the
rows themselves, only distinct values. Percentiles are exact and interpolate linearly at position ``(rows - 1) * p``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reported quantiles and their names.
QUANTILES = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def ratio(numerator: Column, denominator: Column) -> Column:
    """A fraction that is 0.0 over nothing."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def length_stats(value: Column, n: Column) -> Column:
    """``STRUCT<p50,p90,p95,p99,mean>`` of a histogram; NULL percentiles and mean 0.0 over nothing."""
    points = F.percentile(value, [float(p) for p in QUANTILES.values()], n)
    mean = ratio(F.sum(value * n), F.sum(F.when(value.isNotNull(), n)))
    return F.struct(
        *[F.get(points, F.lit(i)).alias(name) for i, name in enumerate(QUANTILES)],
        mean.alias("mean"),
    )
