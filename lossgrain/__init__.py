"""Loan-level loss-given-default analytics as Spark DataFrame operators."""

__version__ = "0.1.0"
