"""Join helpers.

Which side of a join is broadcast is left to Spark: the optimizer's size
estimate against ``spark.sql.autoBroadcastJoinThreshold``, and AQE with the
sizes it measures.  No job is started to find out, and a hint (which would
override those limits) is given only to a frame whose row count follows from
parameters alone, such as the calendar, after projection to its key columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows up to which a frame of known length is hinted.
MAX_BROADCAST_ROWS = 200_000


def broadcast_known(df: DataFrame, rows: int | None) -> DataFrame:
    """``df`` with a broadcast hint if it is known to hold few rows."""
    small = rows is not None and rows <= MAX_BROADCAST_ROWS
    return F.broadcast(df) if small else df
