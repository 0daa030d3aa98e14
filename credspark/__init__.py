"""credspark: risk-style classification data work as Spark DataFrame operators.

Every operator takes and returns a DataFrame; work is done by Spark's own
aggregates, joins, windows and ML estimators.  See README.md for the map.
"""

from credspark.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
