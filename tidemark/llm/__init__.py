"""Operations for preparing training text: thirteen operators and their queries.

Nothing else in the library imports this package; ``__spark_entry__`` adds its
queries when it is present. The functions that run inside Python workers are
shipped to the executors by value, so the executors need no copy of this
repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
