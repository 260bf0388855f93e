"""Operators for preparing training data. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code: they need no copy of it there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
