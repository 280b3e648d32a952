"""Spark-native toolkit for lake and warehouse ETL."""

from lakeloom.session import get_session

__all__ = ["get_session"]
