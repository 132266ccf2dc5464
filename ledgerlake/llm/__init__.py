"""Operators for large-scale training-data pipelines over ``documents``.

Nothing else in the library imports this subpackage.  ``registry`` lists the
queries it offers to ``__spark_entry__``.

Functions that run in tasks travel inside their closures, so executors need
no copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
