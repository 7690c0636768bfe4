import datetime as dt
import logging
import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salescast.operators import clean, encode, features, impute, profile
from salescast.operators import split as splits
from salescast.operators.enrich import enrich_store
from salescast.operators.evaluate import stack_predictions
from salescast.sources.schemas import FEATURES

quick = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def column(df, name):
    return [r[0] for r in df.select(name).collect()]


# Join


def test_unmatched_fact_is_kept_and_duplicate_store_doubles_rows(spark):
    facts = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "store int, sales int")
    stores = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "store int, store_type string")
    rows = sorted((r.store, r.store_type or "") for r in enrich_store(facts, stores).collect())
    assert rows == [(1, "a"), (2, "b"), (2, "c"), (3, "")]


def test_shuffled_join_with_a_hot_store(spark):
    facts = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("store"))
    stores = spark.range(3000).select(F.col("id").cast("int").alias("store"), F.lit("a").alias("store_type"))
    joined = enrich_store(facts, stores.hint("merge"))
    assert "SortMergeJoin" in joined._jdf.queryExecution().toString()
    assert joined.count() == 3000 and joined.where("store_type is null").count() == 0


# Filters


def test_training_filters(spark):
    df = spark.createDataFrame([(1, 5), (1, 0), (0, 0), (None, 9)], "open int, sales int")
    assert clean.clean(df).collect() == [(1, 5)]
    assert clean.filter_open(df).count() == 2
    audit = profile.cleaning_audit(df).first()
    assert (audit.input_rows, audit.closed_removed, audit.rows_after) == (4, 2, 1)


def test_horizon_keeps_every_row(spark):
    df = spark.createDataFrame([(None,), (0.0,), (1.0,)], "open double")
    assert column(clean.clean(df, is_train=False), "open") == [1.0, 0.0, 1.0]
    other = spark.createDataFrame([(1,)], "store int")
    assert clean.clean(other, is_train=False).columns == ["store"]


# Imputation


@pytest.mark.parametrize("values, expected", [
    ([None, 1.0, 2.0, 10.0, 20.0], 6.0), ([3.0, 1.0, 2.0], 2.0), ([5.0, None], 5.0), ([None, None], None), ([], None),
])
def test_exact_median(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert impute.exact_median(df, "x") == expected


def test_weighted_median(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, 3), (9.0, 2), (None, 50)], "x double, n bigint")
    assert impute.exact_median(df, "x", "n") == statistics.median([1.0] * 5 + [2.0] * 3 + [9.0] * 2)


def test_median_of_many_distinct_values(spark):
    df = spark.range(150_001).select(((F.col("id") * 7919) % 150_001 + 0.5).alias("x"))
    assert impute.exact_median(df, "x") == 75_000.5


@pytest.mark.parametrize("seed, size", [(1, 2000), (2, 1999), (3, 501)])
def test_median_narrows_long_histograms(spark, monkeypatch, seed, size):
    monkeypatch.setattr(impute, "PIECES", 20)
    rng = random.Random(seed)
    values = [round(rng.lognormvariate(3, 2), 2) for _ in range(size)] + [7.0] * (size // 3)
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert impute.exact_median(df, "x") == statistics.median(values)


def test_impute(spark):
    schema = "competition_distance double, promo2_since_week double, promo_interval string"
    df = spark.createDataFrame([(None, None, None), (4.0, 3.0, "Jan"), (8.0, 1.0, "Feb")], schema)
    assert impute.impute(df).first() == (6.0, 0.0, "")
    assert impute.impute(df, distance_fill=1.5).first()[0] == 1.5
    empty = spark.createDataFrame([(None,)], "competition_distance double")
    assert impute.impute(empty).first()[0] is None
    assert impute.impute(spark.createDataFrame([(1,)], "store int")).collect() == [(1,)]


# Date features


def test_calendar(spark):
    days = ["2012-12-31", "2014-12-29", "2016-01-01", "2016-02-29", "2015-08-01"]
    df = spark.createDataFrame([(d, dt.date.fromisoformat(d).isoweekday()) for d in days], "sale_date string, day_of_week int")
    rows = {str(r.sale_date): r for r in features.add_date_features(df).collect()}
    assert (rows["2012-12-31"].week_of_year, rows["2012-12-31"].day_of_year, rows["2012-12-31"].is_month_end) == (1, 366, 1)
    assert (rows["2014-12-29"].week_of_year, rows["2014-12-29"].year) == (1, 2014)
    assert (rows["2016-01-01"].week_of_year, rows["2016-01-01"].is_month_start) == (53, 1)
    assert rows["2016-02-29"].is_month_end == 1
    assert (rows["2015-08-01"].is_weekend, rows["2015-08-01"].is_month_start, rows["2015-08-01"].is_month_end) == (1, 1, 0)


def test_weekend_follows_the_given_weekday(spark):
    df = spark.createDataFrame([("2015-07-29", 6), ("2015-08-01", 1)], "sale_date string, day_of_week int")
    assert column(features.add_date_features(df), "is_weekend") == [1, 0]


@quick
@given(st.lists(st.dates(dt.date(1990, 1, 1), dt.date(2035, 12, 31)), min_size=1, max_size=40))
def test_calendar_agrees_with_python(spark, days):
    df = spark.createDataFrame([(d, d.isoweekday()) for d in days], "sale_date date, day_of_week int")
    for r in features.add_date_features(df).collect():
        d = r.sale_date
        assert (r.year, r.month, r.day) == (d.year, d.month, d.day)
        assert r.week_of_year == d.isocalendar()[1] and r.day_of_year == d.timetuple().tm_yday
        assert r.is_weekend == int(d.isoweekday() >= 6) and r.is_month_start == int(d.day == 1)
        assert r.is_month_end == int((d + dt.timedelta(days=1)).day == 1)


# Competition and promotion


def dated(spark, day, **attributes):
    values = {
        "competition_open_since_month": 0.0, "competition_open_since_year": 0.0, "promo2_since_week": 0.0,
        "promo2_since_year": 0.0, "promo_interval": "", "competition_distance": 5.0, **attributes,
    }
    kinds = {"promo_interval": "string"}
    schema = "sale_date string, day_of_week int, " + ", ".join(f"{c} {kinds.get(c, 'double')}" for c in values)
    df = features.add_date_features(spark.createDataFrame([(day, 1, *values.values())], schema))
    return features.add_promo_features(features.add_competition_features(df)).first()


@pytest.mark.parametrize("year, month, expected", [
    (2014.0, 11.0, 8), (2015.0, 9.0, 0), (0.0, 5.0, 0), (2010.0, 0.0, 0), (None, None, 0), (2010.0, None, 0),
])
def test_competition_months(spark, year, month, expected):
    row = dated(spark, "2015-07-15", competition_open_since_year=year, competition_open_since_month=month)
    assert row.competition_months_open == expected


def test_promo2_weeks_mix_calendar_year_and_iso_week(spark):
    start = {"promo2_since_year": 2013.0, "promo2_since_week": 10.0}
    assert dated(spark, "2014-12-28", **start).promo2_weeks_active == 52 + 52 - 10
    assert dated(spark, "2014-12-29", **start).promo2_weeks_active == 52 + 1 - 10
    assert dated(spark, "2012-12-28", **start).promo2_weeks_active == 0


@pytest.mark.parametrize("day, interval, expected", [
    ("2015-09-10", "Mar,Jun,Sept,Dec", 1), ("2015-10-10", "Mar,Jun,Sept,Dec", 0), ("2015-09-10", "", 0),
    ("2015-01-10", None, 0), ("2015-05-10", "Feb,May,Aug,Nov", 1),
])
def test_promo2_month(spark, day, interval, expected):
    assert dated(spark, day, promo_interval=interval).is_promo2_month == expected


@pytest.mark.parametrize("distance, expected", [(5.0, 1), (0.0, 0), (-1.0, 0), (None, 0)])
def test_has_competition(spark, distance, expected):
    assert dated(spark, "2015-07-15", competition_distance=distance).has_competition == expected


# Encoding


def fitted(spark):
    return encode.fit_labels(spark.createDataFrame([("c",), ("a",), ("a",), ("0",), (None,)], "state_holiday string"))


def test_label_codes(spark):
    labels = fitted(spark)
    assert labels.columns == ("state_holiday",)
    assert {r.label: r.code for r in labels.table.collect()} == {"0": 0, "a": 1, "c": 2, "nan": 3}


def test_unseen_and_missing_labels(spark, caplog):
    df = spark.createDataFrame([("z", "q"), (None, "q"), ("c", "q")], "state_holiday string, store_type string")
    with caplog.at_level(logging.WARNING):
        rows = encode.encode_labels(df, fitted(spark)).collect()
    assert rows == [(-1, "q"), (3, "q"), (2, "q")]
    assert "store_type" in caplog.text


def test_without_categories_nothing_is_encoded(spark):
    df = spark.createDataFrame([(1,)], "store int")
    labels = encode.fit_labels(df)
    assert labels.columns == () and labels.table.count() == 0
    assert encode.encode_labels(df, labels).collect() == [(1,)]


def test_unused_labels_leave_no_join(spark):
    df = spark.createDataFrame([("a", None, 1), ("b", "x", 2)], "store_type string, assortment string, n int")
    encoded = encode.encode_labels(df, encode.fit_labels(df, ["store_type", "assortment"]))
    plan = encoded.select("n", "store_type")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_large_label_sets_are_numbered_in_order(spark):
    rows = [(f"{(i * 7919) % 400:03d}", "x" if i % 3 else None) for i in range(1200)]
    df = spark.createDataFrame(rows, "store_type string, assortment string")
    labels = encode.fit_labels(df, ["store_type", "assortment"])
    local = sorted(labels.table.collect())
    assert [r.code for r in local if r.column == "store_type"] == list(range(400)) and len(local) == 402
    codes = {(r.column, r.label): r.code for r in local}
    expected = sorted((codes["store_type", s], codes["assortment", a or "nan"]) for s, a in rows)
    assert sorted(encode.encode_labels(df, labels).collect()) == expected


@quick
@given(st.lists(st.one_of(st.none(), st.text(max_size=4)), min_size=1, max_size=30))
def test_codes_keep_the_order_of_labels(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "assortment string")
    table = sorted((r.code, r.label) for r in encode.fit_labels(df).table.collect())
    assert [label for _, label in table] == sorted({"nan" if v is None else v for v in values})
    assert [code for code, _ in table] == list(range(len(table)))


# Projection


def test_feature_matrix(spark, caplog):
    df = spark.createDataFrame([tuple(range(len(FEATURES) + 2))], [*reversed(FEATURES), "sales", "customers"])
    assert features.feature_matrix(df).columns == [*FEATURES, "sales"]
    with caplog.at_level(logging.WARNING):
        partial = features.feature_matrix(df.drop("sales", "promo"))
    assert partial.columns == [f for f in FEATURES if f != "promo"]
    assert "promo" in caplog.text


# Split


def days(spark, n, start="2015-01-01"):
    return spark.range(n).selectExpr(f"date_add('{start}', cast(id as int)) as sale_date")


def test_six_weeks_hold_43_dates(spark):
    train, validation = splits.time_split(days(spark, 100))
    assert (train.count(), validation.count()) == (57, 43)


def test_ratio_split(spark):
    train, validation = splits.time_split(days(spark, 11), validation_weeks=None, train_ratio=0.85)
    assert (train.count(), validation.count()) == (8, 3)


def test_undated_rows_are_on_neither_side(spark):
    df = days(spark, 60).union(spark.createDataFrame([(None,)], "sale_date date"))
    assert sum(side.count() for side in splits.time_split(df)) == 60
    cut = splits.split_date(df)
    assert splits.with_split(df, cut).where("split is null").count() == 1
    audit = {r.split: r for r in profile.split_audit(df, cut).collect()}
    assert (audit["train"].rows, audit["validation"].rows) == (17, 43)
    assert audit["validation"].first_date == cut == audit["train"].last_date + dt.timedelta(days=1)


def test_no_dates(spark):
    with pytest.raises(ValueError, match="no dates"):
        splits.split_date(days(spark, 0))


def test_sort_by_date(spark):
    df = days(spark, 50).union(days(spark, 50)).orderBy(F.rand(3))
    dates = column(splits.sort_by_date(df), "sale_date")
    assert dates == sorted(dates) and len(dates) == 100


@quick
@given(st.lists(st.one_of(st.none(), st.dates(dt.date(2014, 1, 1), dt.date(2015, 1, 1))), min_size=1, max_size=30),
       st.integers(0, 20))
def test_sides_partition_the_dated_rows(spark, dates, weeks):
    known = [d for d in dates if d]
    if not known:
        return
    df = spark.createDataFrame([(d,) for d in dates], "sale_date date")
    train, validation = splits.time_split(df, validation_weeks=weeks)
    cut = max(known) - dt.timedelta(weeks=weeks)
    assert sorted(column(train, "sale_date")) == sorted(d for d in known if d < cut)
    assert sorted(column(validation, "sale_date")) == sorted(d for d in known if d >= cut)


# Profiles


def test_dataset_summary(spark):
    df = spark.createDataFrame([(1, None, float("nan")), (None, "x", 2.0)], "a int, b string, c double")
    row = profile.dataset_summary(df, "t").first()
    assert (row.name, row.rows, row.columns, row.missing_cells, row.missing_pct) == ("t", 2, 3, 3, 50.0)
    assert profile.dataset_summary(df.limit(0)).first().missing_pct is None
    assert {r.column: r.missing for r in profile.null_counts(df).collect()} == {"a": 1, "b": 1, "c": 1}
    assert {r.type: (r["columns"], r.missing) for r in profile.column_types(df.withColumn("d", F.col("a"))).collect()} == {
        "int": (2, 2), "string": (1, 1), "double": (1, 1),
    }
    assert profile.remaining_nulls(df.select("a")).collect() == [("a", 1)]
    assert profile.remaining_nulls(df.dropna()).collect() == []


def test_stack_predictions(spark):
    df = spark.createDataFrame([("train", 5, 1.0, 2.0)], "split string, sales int, a double, b double")
    rows = sorted(stack_predictions(df, {"m1": "a", "m2": "b"}).collect())
    assert rows == [("m1", "train", 5.0, 1.0), ("m2", "train", 5.0, 2.0)]
