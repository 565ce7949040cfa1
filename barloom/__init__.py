"""Spark-first engine for market bars: sources, operators, plans and streaming."""

__version__ = "0.1.0"
