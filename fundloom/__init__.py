"""Fund-panel analytics on Spark."""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: functions inside UDFs travel with the job by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
