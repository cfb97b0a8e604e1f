"""Spark-native profiling of network flow tables.

Every public function takes DataFrames and returns DataFrames (or a small fitted model
object), so a job is a chain of calls that Catalyst plans as a whole.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
