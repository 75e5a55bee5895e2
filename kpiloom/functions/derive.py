"""Derived market columns: release label, spike flag, sale price, revenue estimate.

Prices and revenues are computed in decimal so that rounding to cents is an
exact half-up rounding, independent of binary floating-point noise.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiloom.functions.money import col_of
from kpiloom.schemas import RELEASE_EARLY, RELEASE_FULL, SPIKE_PLAYER_THRESHOLD


def release_type(flag: str | Column = "is_early_access") -> Column:
    """'Early Access' when the flag is 1, else 'Full Release' (NULL flag included)."""
    return F.when(col_of(flag) == 1, F.lit(RELEASE_EARLY)).otherwise(F.lit(RELEASE_FULL))


def spike_flag(players: str | Column = "concurrent_players",
               threshold: int = SPIKE_PLAYER_THRESHOLD) -> Column:
    """1 when more than ``threshold`` concurrent players, else 0."""
    return F.when(col_of(players) > threshold, F.lit(1)).otherwise(F.lit(0))


def sale_price(base: str | Column, discount_pct: str | Column, on_sale: str | Column) -> Column:
    """round(base * (1 - discount/100), 2) for rows on sale, else the base price as it is.

    Computed in decimal with eight digits of both; where a decimal cannot hold
    them, in double.
    """
    exact = col_of(base).try_cast("decimal(18,8)") * (F.lit(100).cast("decimal(3,0)") - col_of(discount_pct).try_cast("decimal(11,8)"))
    plain = F.round(col_of(base) * (1 - col_of(discount_pct) / 100), 2)
    discounted = F.coalesce(F.round(exact / 100, 2).cast("double"), plain)
    return F.when(col_of(on_sale) == 1, discounted).otherwise(col_of(base).cast("double"))


def revenue_estimate(players: str | Column, price: str | Column, rate: float,
                     fallback: float) -> Column:
    """round(players * price * rate, 2); ``fallback`` when that is not positive (NULL stays NULL)."""
    exact = col_of(players).try_cast("decimal(10,0)") * col_of(price).try_cast("decimal(16,6)") * F.lit(Decimal(repr(rate)))
    estimate = F.coalesce(F.round(exact, 2).cast("double"), F.round(col_of(players) * col_of(price) * rate, 2))
    return F.when(estimate <= 0, F.lit(float(fallback))).otherwise(estimate)
