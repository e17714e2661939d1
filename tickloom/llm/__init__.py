"""Operators of a training-data pipeline, one module each; ``queries`` registers them.

Tasks get the functions of this package by value, so executors need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
