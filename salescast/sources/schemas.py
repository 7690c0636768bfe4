"""Table schemas and column lists."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


SALES = _schema(
    store=T.IntegerType(),
    day_of_week=T.ByteType(),
    sale_date=T.DateType(),
    sales=T.IntegerType(),
    customers=T.IntegerType(),
    open=T.ByteType(),
    promo=T.ByteType(),
    state_holiday=T.StringType(),
    school_holiday=T.ByteType(),
)

HORIZON = _schema(
    id=T.LongType(),
    store=T.IntegerType(),
    day_of_week=T.ByteType(),
    sale_date=T.DateType(),
    open=T.DoubleType(),
    promo=T.ByteType(),
    state_holiday=T.StringType(),
    school_holiday=T.ByteType(),
)

STORE = _schema(
    store=T.IntegerType(),
    store_type=T.StringType(),
    assortment=T.StringType(),
    competition_distance=T.DoubleType(),
    competition_open_since_month=T.DoubleType(),
    competition_open_since_year=T.DoubleType(),
    promo2=T.IntegerType(),
    promo2_since_week=T.DoubleType(),
    promo2_since_year=T.DoubleType(),
    promo_interval=T.StringType(),
)

# Integer columns in which a missing value is an error.
REQUIRED_SALES = ["store", "day_of_week", "sales", "customers", "open", "promo", "school_holiday"]
REQUIRED_HORIZON = ["id", "store", "day_of_week", "promo", "school_holiday"]

CATEGORICAL = ["state_holiday", "store_type", "assortment"]

# The model inputs, in their order.
FEATURES = [
    "store", "day_of_week", "promo", "school_holiday",
    "state_holiday", "store_type", "assortment",
    "year", "month", "day", "week_of_year", "day_of_year",
    "is_weekend", "is_month_start", "is_month_end",
    "competition_distance", "promo2",
    "competition_months_open", "has_competition",
    "promo2_weeks_active", "is_promo2_month",
]

TARGET = "sales"
DATE = "sale_date"
