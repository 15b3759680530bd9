"""Operators of a training-data pipeline, one module each, and their registered queries.

Functions that run in tasks are sent with their code, and what they use with them
(Spark broadcasts what is large), so executors need not have this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
