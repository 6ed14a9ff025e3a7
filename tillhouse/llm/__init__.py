"""Operators that prepare text for training: one module each, their queries in ``queries.py``."""

import sys

from pyspark import cloudpickle

# Functions for Python workers travel with their code, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
