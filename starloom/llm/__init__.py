"""Operators for building training data: filters, deduplication, mixing, tokens, chat.

The functions that run inside tasks are shipped by value, so executors need only the
public libraries and not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
