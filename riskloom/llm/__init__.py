"""Operators of a training-data pipeline. Nothing else in the library imports this package.

Functions that run in executors are pickled with their code, so a cluster needs no copy of the
package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
