"""Ladders and scores at and around each threshold, with unknown values."""

import pytest
from pyspark.sql import functions as F

from merchtide import model
from merchtide.functions import metrics as mt
from merchtide.functions.numeric import fixed_avg, rounded
from merchtide.operators.rank import top_k
from merchtide.plans import gold, sla

LADDER = [
    ((11.99, 9.0, 9.0, 99.0), model.PUSH_LOW_STOCK),
    ((12.0, 5.0, 4.5, 99.0), model.PUSH_NOW),
    ((12.0, 4.99, 4.5, 45.0), model.PUSH_PROFIT),
    ((12.0, 5.0, 4.49, 44.9), model.PUSH_SECONDARY),
    ((None, 5.0, 4.5, None), model.PUSH_NOW),
    ((None, None, 4.5, 45.0), model.PUSH_PROFIT),
    ((None, None, None, None), model.PUSH_SECONDARY),
]


def test_decision_ladder(spark):
    rows = [(i, *values) for i, (values, _) in enumerate(LADDER)]
    df = spark.createDataFrame(rows, "i int, cover double, roas double, cvr double, margin double")
    got = df.orderBy("i").select(
        mt.decision(F.col("cover"), F.col("roas"), F.col("cvr"), F.col("margin"))).collect()
    assert [r[0] for r in got] == [expected for _, expected in LADDER]


@pytest.mark.parametrize(
    ("decision", "action", "shift"),
    [
        (model.PUSH_NOW, "Push Now", 12.0),
        (model.PUSH_LOW_STOCK, "Guarded Push", 0.0),
        (model.PUSH_PROFIT, "Secondary Push", 5.0),
        (model.PUSH_SECONDARY, "Secondary Push", 5.0),
    ],
)
def test_action_of_decision(spark, decision, action, shift):
    row = spark.range(1).withColumn("a", mt.action_type(F.lit(decision))).select(
        "a", mt.channel_sequence(F.col("a")), mt.action_budget_shift(F.col("a"))).first()
    assert tuple(row) == (action, model.CHANNEL_SEQUENCES[action], shift)


def test_stock_risk(spark):
    df = spark.createDataFrame([(11.9,), (12.0,), (17.9,), (18.0,), (None,)], "c double")
    got = [r[0] for r in df.select(mt.stock_risk(F.col("c"))).collect()]
    assert got == ["High", "Medium", "Medium", "Low", "Low"]


def test_channel_budget(spark):
    df = spark.createDataFrame([(2.3,), (2.29,), (2.0,), (1.99,)], "r double")
    shift = mt.channel_budget_shift(F.col("r"), F.lit(2.0))
    got = [tuple(r) for r in df.select(shift, mt.budget_action(shift)).collect()]
    assert got == [(12.0, "Increase"), (5.0, "Increase"), (5.0, "Increase"), (-8.0, "Reduce")]


def test_reason_is_null_when_a_part_is(spark):
    df = spark.createDataFrame(
        [(10.0, 4.5, 5.1, 20.0), (10.0, None, 5.1, 20.0)], "s double, c double, r double, h double")
    got = df.select(
        mt.reason(F.col("s"), F.col("c"), F.col("r"), F.col("h")),
        mt.reason(F.col("s"), F.col("c"), F.col("r"), F.col("h"), fixed=True)).collect()
    assert got[0][0] == "Demand spike 10.0%, CVR 4.5%, ROAS 5.1x, stock cover 20.0 hrs"
    assert got[0][1] == "Demand spike 10.00%, CVR 4.50%, ROAS 5.10x, stock cover 20.00 hrs"
    assert tuple(got[1]) == (None, None)


def test_guarded_ratios(spark):
    row = spark.range(1).select(
        mt.roas(F.lit(10.0), F.lit(0.0)), mt.percent(F.lit(1), F.lit(0)),
        mt.floored_ratio(F.lit(10.0), F.lit(0.5)), mt.stock_cover(F.lit(30), F.lit(0)),
        mt.order_value(F.lit(10.0), F.lit(3.0), F.lit(5.0)), rounded(F.lit(0.125), 2)).first()
    assert tuple(row) == (0.0, None, 10.0, 30.0, 28.5, 0.12)


def test_mean_leaves_nulls_out(spark):
    df = spark.createDataFrame([(1.5,), (None,), (2.0,)], "v double")
    assert df.agg(fixed_avg(F.col("v"))).first()[0] == 1.75
    assert df.filter("v > 9").agg(fixed_avg(F.col("v"))).first()[0] is None


SCORES = [
    ((False, 45.0, 45.0, 9.9, 2, "MEDIUM"), 0, "LOW"),
    ((True, 45.0, 45.0, 9.9, 2, "MEDIUM"), 45, "MEDIUM"),
    ((False, 44.9, 45.0, 10.0, 2, "MEDIUM"), 35, "MEDIUM"),
    ((False, 44.9, 45.0, 9.9, 3, "LOW"), 30, "MEDIUM"),
    ((True, 44.9, 45.0, 0.0, 0, "LOW"), 65, "HIGH"),
    ((True, 44.9, 45.0, 0.0, 0, "HIGH"), 75, "CRITICAL"),
    ((True, 1.0, 45.0, 99.0, 9, "HIGH"), 100, "CRITICAL"),
    ((False, 44.9, 45.0, 0.0, None, None), 20, "LOW"),
]


def test_risk_score_and_level(spark):
    rows = [(i, *values) for i, (values, _, _) in enumerate(SCORES)]
    df = spark.createDataFrame(
        rows, "i int, miss boolean, rem double, p95 double, delay double, n int, crit string")
    score = sla.risk_score(*[F.col(c) for c in ("miss", "rem", "p95", "delay", "n", "crit")])
    got = df.orderBy("i").withColumn("s", score).select("s", sla.risk_level(F.col("s"))).collect()
    assert [tuple(r) for r in got] == [(s, level) for _, s, level in SCORES]


def test_top_k_equals_filtered_rank(spark):
    df = spark.createDataFrame(
        [(f"P{i:02d}", float(i % 3), 1.0, 1.0) for i in range(20)],
        "sku string, push_score double, roas double, cvr_pct double")
    short = [tuple(r) for r in top_k(df, gold.priority(), 4).orderBy("priority_rank").collect()]
    full = gold.prioritized(df).filter("priority_rank <= 4").orderBy("priority_rank")
    assert short == [tuple(r) for r in full.collect()]


def test_strict_snapshot_of_nothing_fails(spark, data):
    empty = data.channel.filter("orders < 0")
    assert gold.budget_shift(empty).count() == 0
    with pytest.raises(Exception, match="no snapshot"):
        gold.budget_shift(empty, strict=True).collect()
