"""Operators for preparing training data: filters, deduplication, archives, sharding, tokenizing and scoring."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Tasks carry the functions themselves, so executors need not have this package installed.
register_pickle_by_value(sys.modules[__name__])
