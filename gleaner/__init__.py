"""gleaner: review mining, similarity and stream sketches as Spark DataFrame operators."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])  # tasks get these functions with the job; executors need no installation
