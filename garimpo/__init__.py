"""Spark-first analytics engine: messy sources in, checked medallion tables out."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the workers by value: executors need no copy of it on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
