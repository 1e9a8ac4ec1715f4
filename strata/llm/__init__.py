"""Operators for large-scale training-data pipelines, one module each.

Nothing else in the library imports this package; ``__spark_entry__`` adds
its queries only when it can be imported. Text work runs in Arrow batches
(``mapInArrow``) or plain DataFrame functions; Spark partitions, shuffles
and spills everything that grows with the data.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value: they need
# Spark's Python with numpy and pyarrow there, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
