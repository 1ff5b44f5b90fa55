"""tallyloom: tabular cleaning, profiling, statistics, preparation and model evaluation on Spark."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

__version__ = "0.1.0"

# Functions that run on executors travel with the job, so the package need not be installed there.
register_pickle_by_value(sys.modules[__name__])
