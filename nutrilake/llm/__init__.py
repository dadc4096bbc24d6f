"""Operators for building training data at scale.

Thirteen operators (one module each) plus the registered queries
(``nutrilake.llm.queries``).  Nothing else in the library imports this package.

Functions that run inside Python workers are shipped by value, so executors
need no copy of the package on their path.
"""
import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
