"""Operators of a large-scale training-data pipeline (numbered 1 to 13) and their registered queries.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Tasks get this subpackage's functions by value, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
