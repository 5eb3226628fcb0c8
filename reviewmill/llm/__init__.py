"""Operators for preparing language-model training data.  Nothing else in the package imports this one."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the tasks, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
