"""Operators for preparing training data, one module each, and the queries
that apply them to the shared tables (``queries.py``).

Nothing outside this package imports it. Functions that run in Spark tasks
are shipped by value, so executors need numpy and pyarrow but no copy of the
package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
