import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from salescast.sources import readers, schemas, writers

SALES_HEADER = "Store,DayOfWeek,Date,Sales,Customers,Open,Promo,StateHoliday,SchoolHoliday"
HORIZON_HEADER = "Id,Store,DayOfWeek,Date,Open,Promo,StateHoliday,SchoolHoliday"
STORE_HEADER = (
    "Store,StoreType,Assortment,CompetitionDistance,CompetitionOpenSinceMonth,CompetitionOpenSinceYear,"
    "Promo2,Promo2SinceWeek,Promo2SinceYear,PromoInterval"
)


def write(path, header, *lines):
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def test_sales_csv(spark, tmp_path):
    path = write(tmp_path / "train.csv", SALES_HEADER, "1,5,2015-07-31,5263,555,1,1,0,1", "2,7,2015-07-26,0,0,0,0,a,0")
    df = readers.read_sales(spark, path)
    assert df.schema == schemas.SALES
    rows = df.orderBy("store").collect()
    assert rows[0].sale_date == dt.date(2015, 7, 31) and rows[0].state_holiday == "0"
    assert rows[1].state_holiday == "a" and rows[1].open == 0


def test_columns_are_bound_by_name(spark, tmp_path):
    path = write(tmp_path / "train.csv", "Date,Sales,Store,DayOfWeek,Customers,Promo,Open,SchoolHoliday,StateHoliday,Note",
                 "2015-07-31,5263,1,5,555,1,0,1,b,x")
    row = readers.read_sales(spark, path).first()
    assert (row.store, row.sales, row.open, row.promo, row.state_holiday) == (1, 5263, 0, 1, "b")


def test_missing_column(spark, tmp_path):
    path = write(tmp_path / "train.csv", "Store,Date", "1,2015-07-31")
    with pytest.raises(ValueError, match="day_of_week"):
        readers.read_sales(spark, path)


def test_horizon_csv_with_missing_open(spark, tmp_path):
    path = write(tmp_path / "test.csv", HORIZON_HEADER, "1,1,4,2015-09-17,,1,0,0", "2,3,4,2015-09-17,1.0,1,0,0",
                 '3,4,4,2015-09-17,"",1,0,0')
    assert [r.open for r in readers.read_horizon(spark, path).orderBy("id").collect()] == [None, 1.0, None]


def test_store_csv(spark, tmp_path):
    path = write(tmp_path / "store.csv", STORE_HEADER, "1,c,a,1270,9,2008,0,,,", '2,a,a,,11.0,2007,1,13,2010,"Jan,Apr,Jul,Oct"')
    first, second = readers.read_store(spark, path).orderBy("store").collect()
    assert first.promo_interval is None and first.promo2_since_week is None and first.competition_distance == 1270.0
    assert second.promo_interval == "Jan,Apr,Jul,Oct" and second.competition_distance is None
    assert second.competition_open_since_month == 11.0


@pytest.mark.parametrize("line", ["1,5,2015-07-31,9.0,555,1,1,0,1", "1,500,2015-07-31,9,555,1,1,0,1", "1,5,2015-07-31,9"])
def test_malformed_rows_fail(spark, tmp_path, line):
    path = write(tmp_path / "train.csv", SALES_HEADER, line)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        readers.read_sales(spark, path).collect()


def test_missing_file_names_the_path(spark, tmp_path):
    with pytest.raises(AnalysisException, match="nowhere.csv"):
        readers.read_sales(spark, str(tmp_path / "nowhere.csv"))


def test_parquet_nan_becomes_null(spark, tmp_path):
    path = str(tmp_path / "stores")
    spark.range(2).selectExpr(
        "cast(id as int) store", "'a' store_type", "'a' assortment",
        "if(id = 0, cast('NaN' as double), 5d) competition_distance", "1 competition_open_since_month",
        "2000 competition_open_since_year", "0 promo2", "null promo2_since_week", "null promo2_since_year",
        "null promo_interval",
    ).select("*").drop("promo2_since_week", "promo2_since_year", "promo_interval").selectExpr(
        "*", "cast(null as int) promo2_since_week", "cast(null as int) promo2_since_year",
        "cast(null as string) promo_interval",
    ).write.parquet(path)
    df = readers.read_store(spark, path, "parquet")
    assert df.schema == schemas.STORE
    assert [r.competition_distance for r in df.orderBy("store").collect()] == [None, 5.0]


def test_required_columns(spark):
    good = spark.createDataFrame([(1, 2)], "store int, sales int")
    readers.check_required(good, ["store", "sales"])
    bad = good.union(spark.createDataFrame([(None, 2), (None, None)], "store int, sales int"))
    assert {r.column: r.missing for r in readers.required_nulls(bad, ["store", "sales"]).collect()} == {
        "store": 2, "sales": 1,
    }
    with pytest.raises(ValueError, match=r"store \(2\), sales \(1\)"):
        readers.check_required(bad, ["store", "sales"])


def test_load_all_and_enriched(spark, tmp_path):
    write(tmp_path / "train.csv", SALES_HEADER, "1,5,2015-07-31,5263,555,1,1,0,1", "9,5,2015-07-31,10,5,1,1,0,1")
    write(tmp_path / "test.csv", HORIZON_HEADER, "1,1,4,2015-09-17,1,1,0,0")
    write(tmp_path / "store.csv", STORE_HEADER, "1,c,a,1270,9,2008,0,,,")
    tables = readers.load_all(spark, str(tmp_path))
    assert [t.count() for t in tables] == [2, 1, 1]
    enriched_sales, enriched_horizon = readers.load_enriched_all(spark, str(tmp_path))
    assert {r.store: r.store_type for r in enriched_sales.collect()} == {1: "c", 9: None}
    assert enriched_horizon.first().store_type == "c"


def test_forecast_sink(spark, tmp_path):
    path = str(tmp_path / "out" / "forecast")
    table = spark.createDataFrame([(1, 2.5), (2, 0.0)], "id bigint, sales double")
    assert writers.write_forecast(table, path, expected_rows=2) == 2
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["Id", "Sales"] and back.count() == 2
    with pytest.raises(ValueError, match="2 forecast rows for 3"):
        writers.write_forecast(table, path, expected_rows=3)
