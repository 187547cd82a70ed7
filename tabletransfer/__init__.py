"""Moving and reshaping tables with Spark, in batch and as streams."""

import sys

from pyspark import cloudpickle

from tabletransfer.functions.udfs import VERSION as __version__

# Functions that run in tasks travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
