"""Operators of a training-data pipeline, as Spark jobs.

Nothing outside this subpackage imports it.  Its worker functions are pickled by
value, so executors need no copy of the package on their path.
"""

from pyspark import cloudpickle

import tessera

cloudpickle.register_pickle_by_value(tessera)
