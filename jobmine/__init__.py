"""jobmine: prepare, profile and cluster tables of job-posting-like records on Spark."""

import sys

from pyspark import cloudpickle

# The few functions that run inside tasks travel with their code, so executors need numpy and
# pyarrow but no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
