"""Operators for building training text at scale.

Nothing outside this folder imports it.  Functions that run in tasks travel by
value, so executors need numpy, pyarrow and the public libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
