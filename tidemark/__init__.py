"""Subscription revenue-loss warehouse and analyses as Spark DataFrame jobs."""

__version__ = "0.1.0"
