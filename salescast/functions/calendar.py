"""Column expressions on the sale date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or cannot be decided."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def calendar_features(date: str = "sale_date", day_of_week: str = "day_of_week") -> dict[str, Column]:
    """Calendar parts of ``date``; the weekend flag follows the given weekday column (1 = Monday)."""
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "week_of_year": F.weekofyear(date),
        "day_of_year": F.dayofyear(date),
        "is_weekend": flag(F.col(day_of_week) >= 6),
        "is_month_start": flag(F.dayofmonth(date) == 1),
        "is_month_end": flag(F.last_day(date) == F.to_date(date)),
    }
