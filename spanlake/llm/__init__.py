"""Operators of a large-scale training-data pipeline.

Each module holds one operator with its own general interface; ``queries.py``
binds the operators to the tables of a data folder. Nothing outside this
package imports it. Functions that run inside Python tasks are shipped by
value, so executors need the installed libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
