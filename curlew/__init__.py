"""Curlew: a Spark-first engine for curating, auditing and scoring tool-use training records."""

import sys

from pyspark import cloudpickle

# Executors get this package's functions by value, so they need no copy of the repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
