"""Operators for preparing text to train language models on.

Nothing else in the library imports this package. Functions that run inside tasks are sent by value, so
executors need the third-party libraries only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
