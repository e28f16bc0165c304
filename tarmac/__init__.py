"""tarmac - Spark-native flight punctuality analytics.

Cleaning, conforming, joining, profiling and modelling of flight, weather,
airport, aircraft and review records, written as DataFrame -> DataFrame
operators that run unchanged on batch and streaming frames.
"""

from tarmac.session import get_session

__all__ = ["get_session"]
