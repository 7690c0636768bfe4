"""Column expressions on competition and promotion data of a store."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salescast.functions.calendar import flag

# Month names as they appear in promo_interval.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def floor_at_zero(value: Column) -> Column:
    """Negative values become 0; null stays null (``greatest`` would turn it into 0)."""
    return F.when(value < 0, F.lit(0)).otherwise(value)


def _periods_since(year: str, part: str, since_year: str, since_part: str, per_year: int) -> Column:
    elapsed = (F.col(year) - F.col(since_year)) * per_year + (F.col(part) - F.col(since_part))
    known = (F.col(since_year) > 0) & (F.col(since_part) > 0)
    return floor_at_zero(F.when(known, elapsed).otherwise(0)).cast("int")


def competition_months_open() -> Column:
    return _periods_since("year", "month", "competition_open_since_year", "competition_open_since_month", 12)


def has_competition() -> Column:
    return flag(F.col("competition_distance") > 0)


def promo2_weeks_active() -> Column:
    """Calendar year with ISO week, 52 weeks a year: the count drops where the two disagree at year end."""
    return _periods_since("year", "week_of_year", "promo2_since_year", "promo2_since_week", 52)


def is_promo2_month() -> Column:
    """Substring test, so that ``Sept`` matches September."""
    name = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.col("month"))
    return flag(F.contains(F.coalesce(F.col("promo_interval"), F.lit("")), name))
