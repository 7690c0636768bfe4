"""Daily store-sales forecasting on Spark: every step is a DataFrame -> DataFrame function."""

__version__ = "0.1.0"
