"""Aggregate expressions that stay defined on degenerate groups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def correlation(x: str, y: str) -> Column:
    """Pearson correlation over rows where both exist; null when either does not vary."""
    a = F.when(F.col(y).isNotNull(), F.col(x).cast("double"))
    b = F.when(F.col(x).isNotNull(), F.col(y).cast("double"))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
