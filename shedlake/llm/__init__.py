"""Operators that prepare training data: ten operators on documents, vectors, pages and chats.

Nothing else in the library imports this package. Its functions reach the executors by value, so a
cluster needs no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
