"""cohortframe: a Spark-native library for preparing, modelling and auditing
labelled tables.

Every operator is a DataFrame -> DataFrame function built from Spark SQL
expressions, aggregations, joins, windows and MLlib.  Statistics learned on a
training partition are kept as small parameter tables so the same fitted
steps can be applied to validation, test and new data.
"""

from cohortframe.schema import Columns, DEFAULT_COLUMNS
from cohortframe.session import get_session, checkpoint_dir

__all__ = ["Columns", "DEFAULT_COLUMNS", "get_session", "checkpoint_dir"]
