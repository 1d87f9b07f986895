"""ticktide: market-data tables and streams as Spark DataFrames.

Every operator is a plain function, ``DataFrame -> DataFrame`` or
``Column -> Column``, and works on batch and streaming inputs alike.
"""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Functions for Python workers travel with their code, so that workers need not
# have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
