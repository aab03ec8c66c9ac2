"""Operators of a training-data pipeline, over tables of documents and web pages.

Functions that run in tasks travel to the executors by value, so a cluster needs the
libraries they use but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
