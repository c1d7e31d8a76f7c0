"""Operations of a training-data pipeline: near copies, leaks, tokens, personal data, secrets, quality, mixing."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])  # tasks get these functions with the job; executors need no installation
