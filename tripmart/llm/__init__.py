"""Operators for training-data pipelines; nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to the executors with their code, so that a
# job needs no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
