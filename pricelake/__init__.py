"""pricelake: a Spark-native daily-price lakehouse.

Raw per-instrument prices flow through three layers (raw, cleaned, star
schema) and into analyst marts.  Every transformation is a function from
DataFrame(s) to a DataFrame built with the PySpark DataFrame API, so the
heavy work runs on executors and Catalyst plans it.

Sub-packages:
    sources    readers, the test-data binding and the sinks
    functions  Column -> Column expression helpers (rounding, calendar, text)
    operators  the layer transformations, dimensions, fact and marts
    plans      the runnable jobs and the registry of named queries
    streaming  the incremental load as a Structured Streaming query
"""

from pricelake.params import RunParams

__all__ = ["RunParams"]
