"""Every operator as a query over the supplied tables, with an equivalent SQL text.

``QUERIES`` maps a name to ``f(spark, folder) -> DataFrame``; ``ORACLE`` maps it to SQL
that a plain SQL engine can run over the same tables.
"""

from docloom.suite import (
    aggregates,
    conversion,
    filters,
    lookups,
    runs,
    scans,
    searching,
    storing,
)

_MODULES = (scans, storing, filters, conversion, lookups, aggregates, runs, searching)

QUERIES = {name: fn for module in _MODULES for name, fn in module.suite.queries.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.suite.oracle.items()}
