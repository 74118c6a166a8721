"""Spark-native loading, consolidation and reporting of premium-collection rosters."""

import sys

from pyspark import cloudpickle

# Functions that run in executors travel with the job: no executor needs the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
