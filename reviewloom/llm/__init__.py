"""Operators for large text corpora. Nothing else in the package imports this one."""

import sys

from pyspark import cloudpickle

# tasks get the functions of these modules with the query, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
