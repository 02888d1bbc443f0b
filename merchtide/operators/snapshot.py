"""Latest-snapshot filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_time(df: DataFrame, column: str = "timestamp") -> Column:
    """The newest time as a scalar subquery: nothing goes through the driver."""
    return df.agg(F.max(column)).scalar()


def at_latest(
    df: DataFrame,
    column: str = "timestamp",
    clock: Column | None = None,
    strict: bool = False,
) -> DataFrame:
    """Rows of the newest snapshot.

    ``clock`` takes the snapshot time of another table. An empty input gives an
    empty result, or an error at run time when ``strict``.
    """
    if clock is None:
        clock = latest_time(df, column)
    if strict:
        # The check must not be pruned away, so it is part of the compared value.
        message = F.lit(f"no snapshot: column {column} holds no time")
        newest = df.agg(
            F.when(F.max(column).isNull(), F.raise_error(message).cast(df.schema[column].dataType))
            .otherwise(F.max(column))
        ).scalar()
        clock = newest
    return df.filter(F.col(column) == clock)
