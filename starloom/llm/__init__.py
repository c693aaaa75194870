"""Operators of a training-data pipeline; nothing outside this subpackage imports it.

Their functions travel to the executors by value, so no executor needs the package installed.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
