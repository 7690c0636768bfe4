"""Sales, horizon and store tables derived from a TPC-H-like star schema (see FIXTURES.md).

Suppliers play the stores and shipped line items the sales.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.sources import schemas
from salescast.sources.readers import conform

HORIZON_DAYS = 42


def store_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    no_competition = key % 3 == 0
    no_promo2 = key % 2 == 0
    table = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        key.alias("store"),
        F.char(97 + key % 4).alias("store_type"),
        F.char((97 + F.col("s_nationkey") % 3).cast("bigint")).alias("assortment"),
        F.when(key % 10 != 3, F.abs("s_acctbal")).alias("competition_distance"),
        F.when(~no_competition, 1 + key % 12).alias("competition_open_since_month"),
        F.when(~no_competition, 1994 + key % 5).alias("competition_open_since_year"),
        (key % 2).alias("promo2"),
        F.when(~no_promo2, 1 + key % 52).alias("promo2_since_week"),
        F.when(~no_promo2, 1995 + key % 4).alias("promo2_since_year"),
        F.when(no_promo2, None)
        .when(key % 6 == 1, "Jan,Apr,Jul,Oct")
        .when(key % 6 == 3, "Feb,May,Aug,Nov")
        .otherwise("Mar,Jun,Sept,Dec")
        .alias("promo_interval"),
    )
    return conform(table, schemas.STORE)


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lines.groupBy(
        F.col("l_suppkey").cast("int").alias("store"), F.col("l_shipdate").cast("date").alias("sale_date")
    ).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("gross"),
        F.countDistinct("l_orderkey").cast("int").alias("customers"),
        F.max((F.col("l_discount") > 0.05).cast("int")).alias("promo"),
    )


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed on Sundays; open but without sales on the 13th for every seventh store."""
    store, day, month = F.col("store"), F.dayofmonth("sale_date"), F.month("sale_date")
    dow = F.weekday("sale_date") + 1
    by_type = F.when(store % 4 == 1, 4000).when(store % 4 == 2, 500).when(store % 4 == 3, 2500).otherwise(0)
    promo_lift = 1500 * F.col("promo") * F.when(dow.isin(1, 6), 2).otherwise(1)
    amount = 3000 + by_type + promo_lift + 250 * (7 - dow) + F.floor(F.col("gross") / 100)
    closed = dow == 7
    table = _daily(spark, sf_dir).select(
        "store",
        dow.alias("day_of_week"),
        "sale_date",
        F.when(closed | ((store % 7 == 0) & (day == 13)), 0).otherwise(amount).alias("sales"),
        F.when(closed, 0).otherwise(F.col("customers")).alias("customers"),
        F.when(closed, 0).otherwise(1).alias("open"),
        "promo",
        F.when((month == 12) & day.isin(25, 26), "c")
        .when((month == 1) & (day == 1), "a")
        .when((month == 4) & (day == 15), "b")
        .otherwise("0")
        .alias("state_holiday"),
        F.when(month.isin(7, 8), 1).otherwise(0).alias("school_holiday"),
    )
    return conform(table, schemas.SALES)


def last_training_day(spark: SparkSession, sf_dir: str) -> dt.date:
    """Six weeks before the last shipped day. A literal, so that the date filter reaches the scan."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lines.agg(F.max(F.col("l_shipdate").cast("date"))).first()[0] - dt.timedelta(days=HORIZON_DAYS)


def sales_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_sales(spark, sf_dir).where(F.col("sale_date") <= last_training_day(spark, sf_dir))


def horizon_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No target; ``open`` missing for every eleventh store; holiday kind ``z`` unseen in training."""
    date = F.col("sale_date")
    table = (
        raw_sales(spark, sf_dir)
        .where(date > last_training_day(spark, sf_dir))
        .withColumns(
            {
                "id": F.col("store").cast("bigint") * 100000000
                + F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date),
                "open": F.when(F.col("store") % 11 != 0, F.col("open")),
                "state_holiday": F.when(F.dayofmonth(date) == 31, "z").otherwise(F.col("state_holiday")),
            }
        )
    )
    return conform(table, schemas.HORIZON)
