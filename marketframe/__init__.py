"""marketframe: Spark-native market-data and portfolio analytics.

Every operator is a function ``DataFrame -> DataFrame`` built from the
PySpark DataFrame API, so Catalyst sees one lazy plan per query.
"""

from marketframe.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
