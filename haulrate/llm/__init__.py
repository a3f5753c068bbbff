"""Operators of a training-data pipeline over ``documents`` and ``pages``.

What runs inside tasks is sent to the executors by value, so only the public packages it imports
have to be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
