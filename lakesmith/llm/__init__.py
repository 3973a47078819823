"""Training-data operators (documents, pages) built on Spark.

Each module holds one operator with its own general interface; the thin
registered queries and their SQL live in ``queries.py``.  Nothing else in the
library imports this package.
"""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel whole, so workers need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
