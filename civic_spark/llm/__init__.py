"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage.  Its task functions are pickled by value, so executors need
numpy and pyarrow but not this package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
