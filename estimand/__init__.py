"""Causal inference and experiment analytics as plain Spark jobs.

Every operator takes a DataFrame and returns a DataFrame (or a small model
object whose methods do).  Raw rows are only touched by Spark expressions,
aggregations, windows and shuffles; Python sees moment rows, per-value counts
or one hash bucket at a time.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Finalizers run in Python workers.  Pickling them by value means executors
# need no installed copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
