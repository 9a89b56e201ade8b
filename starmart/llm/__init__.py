"""Operators for preparing language-model training data, one module each."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with them: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
