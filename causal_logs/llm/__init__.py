"""Operations for preparing training text.

Nothing else in the library imports this package. Its functions travel to the
executors by value, so executors need numpy, pyarrow and the named libraries, but
not this library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
