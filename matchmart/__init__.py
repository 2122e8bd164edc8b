"""matchmart: a Spark-native batch warehouse for match telemetry.

Nested match documents are landed, flattened into match and player-per-match
detail tables, rolled up into dimensions, daily summaries and ratio metrics,
checked by a gated set of data quality rules, profiled, and published over JDBC.
Every dataset is a DataFrame -> DataFrame function built from Spark built-ins.
"""

from matchmart.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
