"""Operators for large training-data pipelines.

Nothing else in the library imports this subpackage; it uses only the general
session helpers of :mod:`panelkit.session`.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so that jobs
# run on clusters where the package is installed on the driver alone.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
