"""Training-data operators: cleaning, deduplication, scoring and packing of a text corpus."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
