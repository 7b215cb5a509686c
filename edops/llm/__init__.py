"""Operators of a training-data pipeline; nothing else in the library imports this folder."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their code, so workers need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
