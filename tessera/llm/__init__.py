"""Operators for preparing language-model training corpora.

Nothing else in the library imports this subpackage.  Its modules ship to the
executors by value, so a job needs no copy of the package on the workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
