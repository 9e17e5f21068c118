"""textlake: DataFrame operators that turn business tables, feeds and documents
into clean, searchable tables on Spark."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with the job, so that no
# executor needs a copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
