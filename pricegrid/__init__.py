"""Hourly price series on Spark: axis, repair, features, tables, models, reports."""
