"""Every operator as a query over the given tables, with the SQL it has to agree with."""

from askloom.workload import (  # noqa: F401
    chunks, evaluation, logs, reporting, retrieval, sources, sync,
)
from askloom.workload.registry import ORACLE, QUERIES  # noqa: F401
