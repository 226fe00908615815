"""spanlake: trace analytics on Spark DataFrames.

Operators take DataFrames and return lazy DataFrames. Actions run only in the
sinks (writers), the iterative tree walk (one count per round), the one-time
writes of derived tables, and
the stream drivers (which run a stream over what is available, then return
its sink as a DataFrame).
"""

from spanlake.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
