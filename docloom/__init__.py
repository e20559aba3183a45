"""Multi-tenant tables to searchable JSON documents, on Spark.

Index definitions are Spark SQL queries.  A run turns their rows into documents,
merges them into one versioned Parquet table per document type and records how far
each tenant has been indexed.  See README.md for the map of the package.
"""

from docloom.model import IndexDef, IndexSet, ParentLink, Tenant
from docloom.plans.indexer import Indexer
from docloom.session import build_session

__all__ = ["IndexDef", "IndexSet", "Indexer", "ParentLink", "Tenant", "build_session"]
