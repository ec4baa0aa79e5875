"""Behaviour analytics for clickstream tables and streams, built on Spark DataFrames."""

from footfall.session import session

__all__ = ["session"]
