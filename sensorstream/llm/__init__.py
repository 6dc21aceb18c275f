"""Operators of a training-data pipeline over document tables.

Each module is one operator with a general DataFrame interface; ``queries``
holds the thin registered queries and their SQL.  Nothing else in the library
imports this package.

Functions that run in Python workers travel by value with their tasks, so
executors need no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
