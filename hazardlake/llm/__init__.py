"""Operators for large training-text pipelines, re-expressed on Spark.

Nothing else in the library imports this subpackage. Functions that run in
Python tasks travel by value, so executors need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
