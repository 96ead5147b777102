"""Operators of a training-data pipeline over documents and web pages.

Their functions are sent to the executors by value, so that these need no copy
of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
