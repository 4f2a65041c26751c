"""Live operators.

Spark first starts a stateful processor in a Python process of the driver that
does not see shipped files, so step functions travel by value.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
