"""strandline: shoreline-change analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value, so that a job needs the package on the driver alone.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
