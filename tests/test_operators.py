"""Operators against brute force on small random inputs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from merchtide.model import PRODUCT
from merchtide.operators import rank
from merchtide.operators.columns import cast_to_schema, normalize_columns
from merchtide.operators.dedupe import keep_newest
from merchtide.operators.ledger import share_of_total, stock_ledger
from merchtide.operators.quality import check_table, split_invalid
from merchtide.operators.rank import percentiles, ranked
from merchtide.operators.upsert import upsert


def ledger_by_loop(moves, rule):
    out = {}
    for sku in {m[0] for m in moves}:
        slots = {}
        for s, t, base, units, restock in moves:
            if s == sku:
                u, r, _ = slots.get(t, (0, 0, base))
                slots[t] = (u + units, r + restock, base)
        level = None
        for t in sorted(slots):
            units, restock, base = slots[t]
            opening = base if level is None else level
            sold = units if rule == "floor" else min(units, opening)
            level = max(0, opening - sold + restock)
            out[sku, t] = (opening, sold, restock, level)
    return out


@pytest.mark.parametrize("rule", ["floor", "sell_available"])
def test_ledger_equals_loop(spark, rule):
    rng = random.Random(7)
    moves = [
        # One product has a third of all movements, several per slot.
        ("hot" if rng.random() < 0.34 else f"P{rng.randrange(40)}", rng.randrange(30), 25,
         rng.randrange(12), rng.choice([0, 0, 0, 9, 30]))
        for _ in range(3000)
    ]
    df = spark.createDataFrame(
        moves, "sku string, timestamp int, base_stock int, units int, restock int")
    got = {(r.sku, r.timestamp): tuple(r)[2:] for r in stock_ledger(df, rule).collect()}
    assert got == ledger_by_loop(moves, rule)


def test_rank_equals_sorting(spark):
    rng = random.Random(3)
    # A third of the rows share one group, and most scores are equal.
    rows = [
        ("hot" if i % 3 == 0 else f"g{rng.randrange(50)}", rng.choice([1.0, 1.0, 1.0, 2.0]), i)
        for i in range(5000)
    ]
    df = spark.createDataFrame(rows, "g string, score double, id int").repartition(7)
    order = [F.col("score").desc(), F.col("id").asc()]
    whole = {r.id: r.rank for r in ranked(df, order, name="rank").collect()}
    expected = sorted(rows, key=lambda r: (-r[1], r[2]))
    assert whole == {r[2]: i + 1 for i, r in enumerate(expected)}
    grouped = {r.id: r.rank for r in ranked(df, order, ["g"], "rank").collect()}
    seen, by_group = {}, {}
    for g, _, i in expected:
        seen[g] = seen.get(g, 0) + 1
        by_group[i] = seen[g]
    assert grouped == by_group


def test_hot_group_spreads_over_partitions(spark, monkeypatch):
    staged = []

    def keeping(df, label):
        staged.append(rank.storage_stage(df, label))
        return staged[-1]

    monkeypatch.setattr(rank, "storage_stage", rank.stage, raising=False)
    monkeypatch.setattr(rank, "stage", keeping)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(40000).withColumn("g", F.when(F.col("id") % 3 > 0, "hot").otherwise("cold"))
        assert ranked(df, [F.col("id").desc()], ["g"], "n").count() == 40000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = staged[0].groupBy(F.shiftright("_row", 33)).count().collect()
    assert max(r["count"] for r in sizes) < 2 * 40000 / len(sizes)


def test_rank_of_null_groups_and_nothing(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, id int")
    got = sorted((r.id, r.n) for r in ranked(df, [F.col("id").asc()], ["g"], "n").collect())
    assert got == [(1, 1), (2, 2), (3, 1)]
    assert ranked(df.filter("id > 9"), [F.col("id").asc()], name="n").count() == 0


def test_percentiles_equal_numpy(spark):
    rng = random.Random(5)
    rows = [("hot" if i % 3 == 0 else f"g{i % 11}", rng.randrange(1000), i) for i in range(3000)]
    df = spark.createDataFrame([*rows, ("hot", None, -1)], "g string, v long, id int")
    got = {r.g: (r.p50, r.p95) for r in
           percentiles(df, "g", "v", "id", {"p50": 0.5, "p95": 0.95}).collect()}
    for g in {r[0] for r in rows}:
        values = [r[1] for r in rows if r[0] == g]
        assert got[g] == pytest.approx((np.percentile(values, 50), np.percentile(values, 95)))
    one = spark.createDataFrame([("a", i, i) for i in (1, 2, 3, 4)], "g string, v long, id int")
    assert percentiles(one, "g", "v", "id", {"p": 0.95}).first().p == pytest.approx(3.85)


def test_newest_row_wins_whatever_the_order(spark):
    rows = [("k", 1, "old"), ("k", 2, "a"), ("k", 2, "b"), (None, 1, "x"), (None, 0, "y")]
    for seed in range(3):
        mixed = random.Random(seed).sample(rows, len(rows))
        df = spark.createDataFrame(mixed, "key string, at int, v string").repartition(3)
        got = {r.key: r.v for r in keep_newest(df, ["key"], ["at"]).collect()}
        assert got == {"k": "b", None: "x"}


def test_upsert_equals_dict(spark):
    rng = random.Random(1)
    old = {i: rng.random() for i in range(300)}
    new = {i: rng.random() for i in range(200, 450)}
    target = spark.createDataFrame([*old.items(), (None, 0.5)], "k int, v double")
    source = spark.createDataFrame([*new.items(), (None, 0.7)], "k int, v double")
    once = upsert(target, source, ["k"])
    rows = [tuple(r) for r in once.collect()]
    assert {k: v for k, v in rows if k is not None} == {**old, **new}
    assert sorted(v for k, v in rows if k is None) == [0.5, 0.7]
    keyed = source.filter("k is not null")
    again = upsert(once, keyed, ["k"])
    assert sorted(map(repr, again.collect())) == sorted(map(repr, once.collect()))


def test_upsert_fills_columns_one_side_lacks(spark):
    target = spark.createDataFrame([(1, "a")], "k int, old string")
    source = spark.createDataFrame([(2, 9)], "k int, new int")
    rows = {r.k: (r.old, r.new) for r in upsert(target, source, ["k"]).collect()}
    assert rows == {1: ("a", None), 2: (None, 9)}


def test_share_of_zero_total_is_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 0.0)], "g string, v double")
    got = {(r.g, r.v): r.share for r in share_of_total(df, ["g"], "v").collect()}
    assert got == {("a", 1.0): 0.25, ("a", 3.0): 0.75, ("b", 0.0): None}


def test_names_and_casts(spark):
    raw = spark.createDataFrame(
        [("P1", "12.0", "7.255", "x"), ("P2", "many", "-", "x")],
        ["SKU", "Base-Stock", " Unit Price", "other"])
    typed = cast_to_schema(raw, PRODUCT)
    assert typed.columns == list(PRODUCT.columns)
    rows = {r.sku: r for r in typed.collect()}
    assert (rows["P1"].base_stock, float(rows["P1"].unit_price)) == (12, 7.26)
    assert (rows["P2"].base_stock, rows["P2"].unit_price, rows["P2"].brand) == (None, None, None)
    with pytest.raises(ValueError, match="collide"):
        normalize_columns(spark.createDataFrame([(1, 2)], ["a b", "A-B"]))


def test_quality_rules_in_one_pass(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", -1), (None, 2), (None, None), ("b", 3)], "k string, orders int")
    found = check_table(df, "t", ["k", "missing"], ["k"], ["orders"], "run", "silver")
    got = {r.rule_name: (r.rule_status, r.failed_count) for r in found.collect()}
    assert got == {
        "not_null:k": ("FAIL", 2), "not_null:missing": ("FAIL", 5),
        "non_negative:orders": ("FAIL", 1), "unique_key:k": ("FAIL", 2),
    }
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1
    empty = check_table(df.filter("orders > 99"), "t", ["k"], ["k"])
    assert {(r.rule_status, r.failed_count) for r in empty.collect()} == {("PASS", 0)}
    good, bad = split_invalid(df, ["k"], ["orders"])
    assert (good.count(), bad.count()) == (2, 3)
