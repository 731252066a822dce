"""factloom: a Spark-first engine that turns long documents into structured, traceable facts."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python workers get our functions by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
