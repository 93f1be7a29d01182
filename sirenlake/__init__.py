"""Dispatch analytics as Spark jobs: every operator maps DataFrames to DataFrames."""

import sys

from pyspark import cloudpickle

# The few Arrow functions travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
