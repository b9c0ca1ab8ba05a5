"""Operators for preparing training text. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors with their code, so that
# a cluster needs no installed copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
