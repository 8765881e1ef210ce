"""Tabular feature engineering, model fitting, scoring and evaluation as Spark jobs."""

__version__ = "0.1.0"
