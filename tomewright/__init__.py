"""tomewright: a PySpark-native analytics library for curated document corpora and rule catalogues."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Functions sent to executors travel by value, so that workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
