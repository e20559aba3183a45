"""Row sources: shared tables, per-tenant tables, JDBC, files and change logs."""

from docloom.sources.files import binary_documents
from docloom.sources.jdbc import TenantJdbc, jdbc_options
from docloom.sources.tables import SharedTables, TenantTables

__all__ = ["SharedTables", "TenantJdbc", "TenantTables", "binary_documents", "jdbc_options"]
