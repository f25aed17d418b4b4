"""Training-data operators: ten corpus operators and the queries that apply them.

Nothing outside this folder and ``corpus_pipeline.py`` imports it. Functions that run in Python workers are
shipped by value, so executors need PySpark and the numeric libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
