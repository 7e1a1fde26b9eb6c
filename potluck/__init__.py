"""potluck: catalogue and interaction analytics as Spark DataFrame operators.

Every operator is a pure function ``DataFrame -> DataFrame`` built from Spark
SQL expressions, joins, windows and aggregates, so Catalyst plans it and the
work is spread over the cluster.  Column names are parameters.
"""

from potluck.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
