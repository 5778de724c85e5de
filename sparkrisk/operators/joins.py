"""Broadcast only what has a proven size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def max_rows(df: DataFrame) -> int | None:
    """Upper bound on the row count that Catalyst can prove from the plan (a ``limit``,
    a one-row aggregate, ...), or None."""
    try:
        bound = df._jdf.queryExecution().optimizedPlan().maxRows()
    except AttributeError:  # no JVM handle (remote client): the bound is unknown
        return None
    return int(bound.get()) if bound.isDefined() else None


def bounded_broadcast(df: DataFrame, limit: int) -> DataFrame:
    """Mark ``df`` for broadcast when the plan proves at most ``limit`` rows; otherwise leave
    the join strategy to adaptive execution, which measures the side at run time and falls
    back to a shuffle join when it is large."""
    bound = max_rows(df)
    return F.broadcast(df) if bound is not None and bound <= limit else df
