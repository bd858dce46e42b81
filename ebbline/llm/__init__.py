"""Operators for large text corpora used as training data."""

import sys

from pyspark import cloudpickle

# Tasks carry the functions of this subpackage with them, so workers need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
