"""Layered (bronze, silver, gold) data products with data-quality bookkeeping on PySpark.

Every operator is a ``DataFrame -> DataFrame`` function; the same function serves batch and
Structured Streaming unless its docstring says otherwise.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
