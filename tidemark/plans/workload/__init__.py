"""The operators run over the star-schema tables, each beside its SQL equivalent.

The tables stand in for registry data: ``events`` for the catalog log, ``part``
for packages, ``supplier`` for the license list, ``pages`` for URLs, ``orders``
for runs and cursor scans.
"""

from tidemark.plans.workload import (  # noqa: F401  (each import registers its queries)
    capture,
    documents,
    license_queries,
    operations,
    scalars,
)
from tidemark.plans.workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
