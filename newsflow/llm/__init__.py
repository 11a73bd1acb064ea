"""Training-data operators (nothing else in the library imports this subpackage).

Worker functions of this subpackage are pickled by value, so Python workers
need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
