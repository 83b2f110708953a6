"""Operators for preparing training data: one module per operator, one for their queries."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions that run in tasks travel with the job, so executors need not have this package.
register_pickle_by_value(sys.modules[__name__])
