"""Operators for training-data pipelines.  Nothing else in the library
imports this package; ``__spark_entry__`` adds its queries when it is there."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so executors need no copy
# of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
