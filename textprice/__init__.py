"""Spark-first text-and-price analytics.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL expressions,
DataFrame operators and Spark ML stages.  Sub-packages:

* ``sources``   – table loading, derived fixture views, file/JSON sources and sinks, paging
* ``functions`` – column expressions (text cleaning, labels, hashing)
* ``operators`` – relational, statistical, feature, model and time-series operators
* ``plans``     – composed plans (preprocessing/model pipelines, daily features, query catalog)
* ``streaming`` – Structured Streaming ingest, scoring, correlation, live totals
"""

import sys as _sys

# Python workers (pandas UDFs) need the package's functions.  Ship them by value with each
# task, so executors need no installed copy of this package.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: install the package on executors
    pass

__all__ = ["session"]
