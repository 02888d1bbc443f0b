"""Marketing and stock metrics, and the decision ladder built on them."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from merchtide import model
from merchtide.functions.numeric import clamped, ratio, rounded
from merchtide.model import Thresholds


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return rounded(ratio(part, whole) * 100.0, digits)


def roas(revenue: Column, spend: Column) -> Column:
    """Revenue per unit of spend, 0 when nothing was spent."""
    return rounded(F.coalesce(ratio(revenue, spend), F.lit(0.0)), 2)


def floored_ratio(top: Column, bottom: Column) -> Column:
    """Channel ratios: the denominator never falls below one."""
    return ratio(top, F.greatest(bottom.cast("double"), F.lit(1.0)))


def push_score(spike: Column, roas_: Column, cvr: Column, margin: Column, ctr: Column) -> Column:
    reach = clamped(ctr * 12.0, high=100.0)
    return _weighted(spike, roas_, cvr, margin, reach)


def push_score_by_cover(
    spike: Column, target_roas: Column, cvr: Column, margin: Column, cover: Column
) -> Column:
    """The variant that rewards stock cover up to one day in place of clicks."""
    reach = clamped(cover / 24.0 * 100.0, high=100.0)
    return _weighted(spike, target_roas, cvr, margin, reach)


def _weighted(spike, roas_, cvr, margin, reach) -> Column:
    # The weights of the five parts.
    score = (
        F.lit(0.27) * spike
        + F.lit(0.18) * roas_ * 10.0
        + F.lit(0.18) * cvr * 10.0
        + F.lit(0.17) * margin
        + F.lit(0.10) * reach
    )
    return rounded(score, 1)


def stock_cover(closing: Column, units_sold: Column) -> Column:
    return rounded(ratio(closing, F.greatest(units_sold, F.lit(1))), 1)


def stock_risk(cover: Column, t: Thresholds = Thresholds()) -> Column:
    return (
        F.when(cover < t.stock_low_hrs, "High")
        .when(cover < t.stock_medium_hrs, "Medium")
        .otherwise("Low")
    )


def order_value(price: Column, quantity: Column, discount_pct: Column) -> Column:
    return rounded(price * quantity * (F.lit(1.0) - discount_pct / 100.0), 2)


def demand_index(volume: Column, usual: Column, floor: float = 0.0) -> Column:
    """Volume as a percentage of what is usual for the slot."""
    return rounded(clamped(ratio(volume, usual) * 100.0, low=floor), 2)


def decision(cover: Column, roas_: Column, cvr: Column, margin: Column,
             t: Thresholds = Thresholds()) -> Column:
    """First matching rung; an unknown value never matches its rung."""
    return (
        F.when(cover < t.stock_low_hrs, model.PUSH_LOW_STOCK)
        .when((roas_ >= t.min_push_roas) & (cvr >= t.min_push_cvr), model.PUSH_NOW)
        .when(margin >= t.profit_margin, model.PUSH_PROFIT)
        .otherwise(model.PUSH_SECONDARY)
    )


def action_type(decision_: Column) -> Column:
    return (
        F.when(decision_ == model.PUSH_NOW, "Push Now")
        .when(decision_ == model.PUSH_LOW_STOCK, "Guarded Push")
        .otherwise("Secondary Push")
    )


def _mapped(key: Column, table: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])[key]


def channel_sequence(action: Column) -> Column:
    return _mapped(action, model.CHANNEL_SEQUENCES)


def action_budget_shift(action: Column) -> Column:
    return _mapped(action, model.BUDGET_SHIFTS)


def channel_budget_shift(roas_: Column, mean_roas: Column) -> Column:
    return (
        F.when(roas_ >= mean_roas * 1.15, 12.0).when(roas_ >= mean_roas, 5.0).otherwise(-8.0)
    )


def budget_action(shift: Column) -> Column:
    return F.when(shift > 0, "Increase").otherwise("Reduce")


def reason(spike: Column, cvr: Column, roas_: Column, cover: Column,
           fixed: bool = False) -> Column:
    """The sentence behind a recommendation; NULL as soon as one part is NULL."""

    def text(value: Column) -> Column:
        # format_string prints a NULL as the word, cast keeps it NULL.
        shown = F.format_string("%.2f", value.cast("double")) if fixed else value.cast("string")
        return F.when(value.isNotNull(), shown)

    return F.concat(
        F.lit("Demand spike "), text(spike), F.lit("%, CVR "), text(cvr),
        F.lit("%, ROAS "), text(roas_), F.lit("x, stock cover "), text(cover), F.lit(" hrs"),
    )
