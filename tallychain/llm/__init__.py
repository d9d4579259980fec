"""Operators of a training-data pipeline: one module per operator, their queries in ``queries``.

Python workers get these functions by value, so that executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
