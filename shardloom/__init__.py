"""Media-dataset preparation on Spark: scans, tags, prompts, request logs, packing and text operators."""

import sys

from pyspark import cloudpickle

# Workers need no copy of the package: its functions travel with the tasks that call them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
