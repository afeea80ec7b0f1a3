"""Money arithmetic in decimal so that totals are exact and engine independent.

Rule: amount = price x quantity x (1 - pct / 100), rounded half-up to cents. Operands are
cast to decimals first, the product is exact, one rounding happens at the end. Totals are
exact decimal sums converted to double last; averages are that total divided by the number
of non-null amounts (never decimal ``avg``, whose result scale differs between engines).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.schema import MONEY


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def line_amount(unit_price: Column | str, quantity: Column | str, discount_pct: Column | str) -> Column:
    """price x qty x (1 - pct/100) as decimal(18,2), half-up at two places.

    The operands keep six places of the price and four of the percent, and any 32-bit
    quantity; their product is exact and rounded once.
    """
    price = _c(unit_price).cast("decimal(16,6)")
    qty = _c(quantity).cast("decimal(10,0)")
    keep = ((F.lit(100) - _c(discount_pct)) / F.lit(100)).cast("decimal(9,6)")
    return (price * qty * keep).cast(MONEY)


def money(c: Column | str) -> Column:
    """A money value as decimal(18,2) (exact for values that came from cents)."""
    return _c(c).cast(MONEY)


def money_sum(c: Column | str) -> Column:
    """Exact total of a money column, returned as double."""
    return F.sum(money(c)).cast("double")


def money_avg(c: Column | str) -> Column:
    """Exact total / number of non-null amounts, as double (NULL when there are none)."""
    return F.try_divide(F.sum(money(c)).cast("double"), F.count(_c(c)))
