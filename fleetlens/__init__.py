"""fleetlens - fleet-wide operations-signal analytics on Spark.

Every operator takes DataFrames and returns DataFrames. "Now" is always an
explicit ``as_of`` argument so results are reproducible.
"""

from fleetlens.session import ensure_session, get_spark

__all__ = ["ensure_session", "get_spark"]
