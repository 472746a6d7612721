"""Training-data pipeline operators: scans, extraction, deduplication, search, scoring and packing."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job, so it need
# not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
