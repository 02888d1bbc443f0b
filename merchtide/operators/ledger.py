"""Running stock ledgers and shares of a total."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def stock_ledger(
    moves: DataFrame,
    rule: str = "sell_available",
    sku: str = "sku",
    time: str = "timestamp",
    base: str = "base_stock",
    units: str = "units",
    restock: str = "restock",
) -> DataFrame:
    """Opening and closing stock per product and time slot.

    ``floor``          close = max(0, open - units + restock)
    ``sell_available`` sold = min(units, open); close = open - sold + restock

    Both recurrences have a closed form over running sums: a walk reflected at
    zero equals the walk minus its running minimum below zero. The slots of one
    product are summed up first, so a product's window holds at most one row per
    time slot, however many movements it has.
    """
    slots = moves.groupBy(sku, time).agg(
        F.max(base).cast("long").alias("_base"),
        F.sum(F.coalesce(F.col(units), F.lit(0))).cast("long").alias(units),
        F.sum(F.coalesce(F.col(restock), F.lit(0))).cast("long").alias(restock),
    )
    by_time = Window.partitionBy(sku).orderBy(time)
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The walk starts from the stock known at the product's first slot.
    start = F.first("_base").over(so_far)
    if rule == "floor":
        step = F.col(restock) - F.col(units)
    elif rule == "sell_available":
        step = F.lag(restock, 1, 0).over(by_time) - F.col(units)
    else:
        raise ValueError(f"unknown ledger rule {rule}")
    walk = (
        slots.withColumn("_start", start)
        .withColumn("_step", step)
        .withColumn("_walk", F.col("_start") + F.sum("_step").over(so_far))
        .withColumn("_level", F.col("_walk") - F.least(F.lit(0), F.min("_walk").over(so_far)))
    )
    if rule == "floor":
        closed = walk.withColumn("closing_stock", F.col("_level"))
    else:
        closed = walk.withColumn("closing_stock", F.col("_level") + F.col(restock))
    opened = closed.withColumn(
        "opening_stock", F.coalesce(F.lag("closing_stock").over(by_time), F.col("_start"))
    )
    sold = F.col(units) if rule == "floor" else F.least(F.col(units), F.col("opening_stock"))
    return opened.select(
        sku, time, "opening_stock", sold.alias("units_sold"),
        F.col(restock).alias("restocked_units"), "closing_stock",
    )


def share_of_total(df: DataFrame, group: list[str], value: str, name: str = "share") -> DataFrame:
    """Each row's part of its group's total, NULL when the total is zero.

    The totals are an aggregate joined back: a window would pull a whole group
    into one task.
    """
    totals = df.groupBy(*group).agg(F.sum(value).alias("_total"))
    return (
        df.join(totals, group)
        .withColumn(name, F.try_divide(F.col(value), F.col("_total")))
        .drop("_total")
    )
