"""Operators for preparing language-model training data.

One module per operator; ``queries`` applies each to its table. The Python
helpers that run inside tasks are shipped to the executors by value, so an
executor needs numpy and pyarrow but not this package on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
