"""parchment: a PySpark-native engine for governed document retrieval.

Landed documents become versioned, quality-checked, chunked and embedded
tables; tables of queries are answered by vector, keyword (cover density)
and hybrid ranking with filters and citations; retrieval is evaluated and
reranked with Spark ML.  Every stage is a DataFrame job.
"""

import sys as _sys

try:  # ship the package's UDF code with each task (no --py-files needed)
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pyspark
    pass

from parchment.session import get_session, materialize  # noqa: E402

__all__ = ["get_session", "materialize"]
