"""starloom: Spark-native operators for building and maintaining a star-schema warehouse.

Every operator is a function ``DataFrame(s) -> DataFrame`` built from Catalyst column
expressions, joins, aggregations and windows. The processing date is always an argument,
so any batch can be replayed.
"""

from starloom.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
