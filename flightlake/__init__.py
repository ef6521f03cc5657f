"""flightlake — Spark-native analytics over aircraft state vectors.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's
own DataFrame/SQL expressions; Python runs inside tasks only for the tar
scan (Python Data Source) and the isolation forest (pandas functions).
"""

__version__ = "0.1.0"

import sys as _sys

try:  # ship our functions by value so executors need no installed copy
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older pyspark: fall back to --py-files
    pass
