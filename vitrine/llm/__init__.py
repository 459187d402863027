"""Operators for building training corpora. Nothing else in the library imports
this subpackage; ``queries.py`` registers one query per operator.

Functions that run in Python workers are sent there by value, so that executors
need no installed copy of this package."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
