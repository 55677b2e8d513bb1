"""Operators of a training-data pipeline. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# the code of the tasks travels with them, so executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
