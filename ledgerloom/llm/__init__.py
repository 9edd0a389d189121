"""Operators of a training-data pipeline. Nothing else in the package imports this folder.

Functions that run in tasks travel with the plan, so executors need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
