"""tidegate: CSV landing, data-quality gate and table profiling on Spark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few Python functions that run in tasks travel with the job, so executors
# need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
