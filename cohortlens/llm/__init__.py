"""Operators for a large training-data pipeline; nothing else in the library imports them."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions of this package travel to the executors with the plan, so the package needs no installation there.
register_pickle_by_value(sys.modules[__name__])
