"""Operators for preparing training text at scale, and their queries.

Nothing else in the library imports this subpackage; it only borrows the
session helpers (the shared folder) from it.
"""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: functions that run in tasks
# travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
