"""Scans of the three input tables."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.operators.enrich import enrich_store
from salescast.operators.profile import null_counts
from salescast.sources import schemas

SALES_FILE = "train.csv"
HORIZON_FILE = "test.csv"
STORE_FILE = "store.csv"


def column_name(header: str) -> str:
    """``DayOfWeek`` -> ``day_of_week``; the date column is called ``sale_date`` here."""
    name = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", header.strip()).lower()
    return schemas.DATE if name == "date" else name


def nan_to_null(df: DataFrame) -> DataFrame:
    """One kind of missing value: a NaN compares as greater than any number and spoils averages."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema`` with its types, and null for NaN."""
    absent = [f.name for f in schema if f.name not in df.columns]
    if absent:
        raise ValueError(f"input lacks the columns {absent}")
    return nan_to_null(df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]))


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # Only the header line is read here. Columns are bound by name, so their order in the file is free.
    header = spark.read.option("header", True).csv(path).columns
    kinds = {f.name: f.dataType for f in schema}
    in_file = T.StructType([T.StructField(h, kinds.get(column_name(h), T.StringType())) for h in header])
    raw = spark.read.schema(in_file).options(header=True, mode="FAILFAST", enforceSchema=False).csv(path)
    return conform(raw.toDF(*[column_name(h) for h in header]), schema)


def read_table(spark: SparkSession, path: str, schema: T.StructType, format: str = "csv") -> DataFrame:
    """Scan ``path``; a missing path raises ``AnalysisException`` (PATH_NOT_FOUND) at once."""
    if format == "csv":
        return _read_csv(spark, path, schema)
    return conform(spark.read.format(format).load(path), schema)


def read_sales(spark: SparkSession, path: str, format: str = "csv") -> DataFrame:
    return read_table(spark, path, schemas.SALES, format)


def read_horizon(spark: SparkSession, path: str, format: str = "csv") -> DataFrame:
    return read_table(spark, path, schemas.HORIZON, format)


def read_store(spark: SparkSession, path: str, format: str = "csv") -> DataFrame:
    return read_table(spark, path, schemas.STORE, format)


def load_all(spark: SparkSession, data_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The lazy (sales, horizon, store) tables of a folder of CSV files."""
    return (
        read_sales(spark, f"{data_dir}/{SALES_FILE}"),
        read_horizon(spark, f"{data_dir}/{HORIZON_FILE}"),
        read_store(spark, f"{data_dir}/{STORE_FILE}"),
    )


def load_enriched_sales(spark: SparkSession, data_dir: str) -> DataFrame:
    store = read_store(spark, f"{data_dir}/{STORE_FILE}")
    return enrich_store(read_sales(spark, f"{data_dir}/{SALES_FILE}"), store)


def load_enriched_horizon(spark: SparkSession, data_dir: str) -> DataFrame:
    store = read_store(spark, f"{data_dir}/{STORE_FILE}")
    return enrich_store(read_horizon(spark, f"{data_dir}/{HORIZON_FILE}"), store)


def load_enriched_all(spark: SparkSession, data_dir: str) -> tuple[DataFrame, DataFrame]:
    return load_enriched_sales(spark, data_dir), load_enriched_horizon(spark, data_dir)


def required_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, missing): number of missing values in each column that may have none."""
    return null_counts(df.select(*columns))


def _raise_if_missing(counts: dict[str, int]) -> None:
    bad = [f"{column} ({n})" for column, n in counts.items() if n]
    if bad:
        raise ValueError("missing values in required columns: " + ", ".join(bad))


def check_required(df: DataFrame, columns: list[str]) -> None:
    """Raise if a required column has missing values; a scan of its own."""
    _raise_if_missing({r.column: r.missing for r in required_nulls(df, columns).collect()})


def watch_required(df: DataFrame, columns: list[str]) -> tuple[DataFrame, Callable[[], None]]:
    """The same check within a scan that is made anyway: call the second result after an action on the first."""
    seen = Observation()
    watched = df.observe(seen, *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return watched, lambda: _raise_if_missing(seen.get)
