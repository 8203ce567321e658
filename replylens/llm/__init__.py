"""Training-data operators (packing, classifiers, language ID, extraction, mixing,
fingerprints, PII, exact search, similarity join) and their queries.

Nothing else in the library imports this package; the driver entry adds its
queries only when it is present.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Python workers get the functions by value, so an executor needs no copy of the package on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def llm_queries():
    from .queries import QUERIES
    return dict(QUERIES)


def llm_oracles():
    from .oracle import ORACLE
    return dict(ORACLE)
