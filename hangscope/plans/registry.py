"""All registered queries and their oracle statements."""

from hangscope.plans import queries as _q  # noqa: F401  (registers)
from hangscope.plans import queries_ops as _o  # noqa: F401  (registers)
from hangscope.plans import queries_profile as _p  # noqa: F401  (registers)
from hangscope.plans import queries_store as _s  # noqa: F401  (registers)
from hangscope.plans.oracle_queries import ORACLE
from hangscope.plans.queries import REGISTRY

__all__ = ["REGISTRY", "ORACLE"]
