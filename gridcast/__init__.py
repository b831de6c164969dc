"""Load-forecast analytics on Spark: features, forecasts, scoring and monitoring for many zones."""

__version__ = "0.1.0"
