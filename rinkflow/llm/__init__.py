"""Operators for building training corpora.

Nothing outside this folder imports it.  Its functions reach the workers by
value, so executors need no copy of the repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
