"""Small-area cleaning, scoring and quality control as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with their job, so that executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
