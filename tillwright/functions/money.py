"""Prices, margins and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwright.schemas import MONEY

# Share of the list price taken as cost, and the sales tax rate.
STANDARD_COST_FACTOR = "0.55"
STANDARD_TAX_RATE = "0.08"


def rate(value: str | float) -> Column:
    """A rate as an exact decimal literal."""
    return F.lit(str(value)).cast("decimal(9,4)")


def cents(amount: Column) -> Column:
    """Rounded half-up to two decimals and held as money."""
    return F.round(amount, 2).cast(MONEY)


def half_up(value: Column, digits: int) -> Column:
    """A double rounded once, half-up by its shortest decimal text."""
    return F.round(value.cast("double"), digits)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double; null where `whole` is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return half_up(ratio(part, whole) * 100, digits)


def margin_percent(price: Column, cost: Column) -> Column:
    return percent(price - cost, price)


def line_profit(
    net: Column, quantity: Column, price: Column, cost_factor: str | float = STANDARD_COST_FACTOR
) -> Column:
    """Net amount less the assumed cost of the goods, a flat share of their list price.

    The list price keeps its four decimals, so the product with a rate of four is exact.
    """
    return cents(net - (quantity * price).cast("decimal(26,4)") * rate(cost_factor))


def line_amounts(
    gross: Column, discount_pct: Column, tax_rate: Column | None = None
) -> dict[str, Column]:
    """The amounts of one sales line, each rounded before the next builds on it."""
    discount = cents(gross * discount_pct)
    net = (gross - discount).cast(MONEY)
    tax = cents(net * (rate(STANDARD_TAX_RATE) if tax_rate is None else tax_rate))
    return {
        "discount_amount": discount,
        "gross_amount": gross,
        "net_amount": net,
        "tax_amount": tax,
        "total_amount": (net + tax).cast(MONEY),
    }


def price_line(
    price: Column, quantity: Column, discount_pct: Column, tax_rate: Column | None = None
) -> dict[str, Column]:
    """All amounts of a line from its unit price."""
    return line_amounts(cents(price * quantity), discount_pct, tax_rate)
