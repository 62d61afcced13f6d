"""Operators for corpora of training text. Nothing outside this subpackage imports it.

Executors get the functions of this subpackage by value, so it need not be
installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
