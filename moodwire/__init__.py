"""moodwire: sentiment analytics on short texts, as Spark DataFrame and Structured Streaming jobs."""

import sys as _sys

try:  # ship this package's functions by value inside task closures (no install on executors needed)
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older pickler: the package must then be importable on executors
    pass
