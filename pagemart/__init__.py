"""Spark jobs over captured marketplace pages and fetch logs."""

__version__ = "0.1.0"
