"""Row numbers and percentiles over groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchtide.sources.storage import stage

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above this bit


def ranked(
    df: DataFrame,
    order: Sequence[Column],
    group: Sequence[str] = (),
    name: str = "priority_rank",
) -> DataFrame:
    """``row_number`` without a window, so that no group has to fit one task.

    The rows are range-sorted by group and order and staged once; each row's
    place inside its sorted partition plus the sizes of the partitions before it
    is its global place, and a group's rank is counted from its first row.
    ``order`` must be total: end it with a unique column. Then a range boundary
    can fall anywhere, and a hot group spreads over many partitions.
    """
    placed = _placed(df, order, group)
    if not group:
        return placed.withColumnRenamed("_place", name)
    return _from_group_start(placed, group, name).select(*df.columns, name)


def _placed(df: DataFrame, order: Sequence[Column], group: Sequence[str]) -> DataFrame:
    """The rows with their global place, from 1, in group and sort order."""
    keys = [F.col(c).asc() for c in group]
    rows = stage(
        df.orderBy(*keys, *order).withColumn("_row", F.monotonically_increasing_id()), "ranked"
    )
    part = F.shiftright("_row", _ROW_BITS)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    # One row per sort partition, hence the plain window and the broadcast.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before")
    )
    inside = F.col("_row").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        rows.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn("_place", F.col("_before") + inside + 1)
        .drop("_part", "_before", "_row")
    )


def _from_group_start(placed: DataFrame, group: Sequence[str], name: str) -> DataFrame:
    """Add each row's rank in its group and the group's size ``_n``.

    The group table has one row per group; staging it shows the planner its true
    size, which decides between a broadcast and a shuffled join.
    """
    groups = stage(
        placed.groupBy(*[F.col(c).alias(f"_g_{c}") for c in group]).agg(
            F.min("_place").alias("_first"), F.count("*").alias("_n")
        ),
        "ranked-groups",
    )
    same = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in group]
    return placed.join(groups, same).withColumn(name, F.col("_place") - F.col("_first") + 1)


def top_k(df: DataFrame, order: Sequence[Column], k: int, name: str = "priority_rank") -> DataFrame:
    """The first k rows with their rank; only k rows per task travel."""
    head = df.orderBy(*order).limit(k)
    return head.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))


def percentiles(
    df: DataFrame,
    group: str,
    value: str,
    unique: str,
    points: Mapping[str, float],
) -> DataFrame:
    """Exact percentiles per group, linear between neighbours, for groups of any size.

    The percentile at p of n values sits at position (n - 1) * p; only the rows
    next to such a position are kept after ranking.
    """
    known = df.select(group, value, unique).filter(F.col(value).isNotNull())
    placed = _placed(known, [F.col(value).asc(), F.col(unique).asc()], [group])
    sized = _from_group_start(placed, [group], "_rank")
    picked = []
    for name, p in points.items():
        spot = (F.col("_n") - 1) * F.lit(float(p))
        low, high = F.floor(spot), F.ceil(spot)
        share = F.max(spot - low)
        at = lambda where: F.max(F.when(F.col("_rank") - 1 == where, F.col(value)))
        picked.append((at(low) + (at(high) - at(low)) * share).alias(name))
    return sized.groupBy(group).agg(*picked)
