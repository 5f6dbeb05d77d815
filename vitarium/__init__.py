"""Catalogue jobs on Spark: pages to records, record logs, occupation linking."""

import sys

from pyspark import cloudpickle

# The Python step of page extraction travels to executors whole, so they need no copy
# of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
