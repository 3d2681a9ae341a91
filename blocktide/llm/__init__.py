"""Operators for training-data pipelines, each a Spark job over whole tables.

Functions of this package travel to the executors by value, so a cluster needs
numpy, pandas and pyarrow there, but not this library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
