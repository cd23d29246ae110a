"""Operators for preparing training text; nothing else in the library imports them.

Functions that run inside tasks travel by value, so executors need numpy and
pyarrow but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
