"""Operators for training-data pipelines; their queries are in ``llm.queries``.

Functions that run inside tasks travel by value, so executors need none of this package's files.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
