"""Quality rules of one table, evaluated in a single pass."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = ["run_id", "layer", "table_name", "rule_name", "rule_status",
                  "failed_count", "checked_at"]


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of keys that occur more than once; NULL keys form one group."""
    return (
        df.groupBy(*keys).count().agg(F.count_if(F.col("count") > 1).alias("duplicate_keys"))
    )


def check_table(
    df: DataFrame,
    table: str,
    not_null: Sequence[str] = (),
    unique_key: Sequence[str] = (),
    non_negative: Sequence[str] = (),
    run_id: str = "",
    layer: str = "silver",
    checked_at: datetime | None = None,
) -> DataFrame:
    """One row per rule with its status and number of failures.

    NULL and sign counts are gathered per key while the rows are grouped for the
    uniqueness rule, so the table is read once and shuffled once, already
    reduced. A required column the table lacks fails on every row.
    """
    measures = {}
    for name in not_null:
        bad = F.count_if(F.col(name).isNull()) if name in df.columns else F.count("*")
        measures[f"not_null:{name}"] = bad
    for name in non_negative:
        if name in df.columns:
            measures[f"non_negative:{name}"] = F.count_if(F.col(name) < 0)
    rules = list(measures)
    tags = [f"_r{i}" for i in range(len(rules))]
    counted = [measures[r].alias(t) for r, t in zip(rules, tags)]
    if unique_key:
        per_key = df.groupBy(*unique_key).agg(F.count("*").alias("_copies"), *counted)
        totals = per_key.agg(
            *[F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in tags],
            F.count_if(F.col("_copies") > 1).alias("_dup"),
        )
        rules.append("unique_key:" + ",".join(unique_key))
        tags.append("_dup")
    else:
        totals = df.agg(*counted)
    pairs = F.array(
        *[F.struct(F.lit(r).alias("rule"), F.col(t).alias("failed")) for r, t in zip(rules, tags)]
    )
    stamp = F.lit(checked_at) if checked_at else F.current_timestamp()
    return totals.select(F.explode(pairs).alias("r")).select(
        F.lit(run_id).alias("run_id"),
        F.lit(layer).alias("layer"),
        F.lit(table).alias("table_name"),
        F.col("r.rule").alias("rule_name"),
        F.when(F.col("r.failed") == 0, "PASS").otherwise("FAIL").alias("rule_status"),
        F.col("r.failed").cast("long").alias("failed_count"),
        stamp.cast("timestamp").alias("checked_at"),
    )


def split_invalid(
    df: DataFrame, not_null: Sequence[str] = (), non_negative: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Rows that pass the row rules, and the rest for quarantine."""
    bad = F.lit(False)
    for name in not_null:
        bad = bad | F.col(name).isNull()
    for name in non_negative:
        bad = bad | F.coalesce(F.col(name) < 0, F.lit(False))
    return df.filter(~bad), df.filter(bad)
