"""Training-data operators and their pipeline; nothing else in the library imports this package.

Functions that run inside Spark tasks are shipped by value, so executors need
no installed copy of the package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
