"""The parent index: one document table per type, and the views tenants read."""

from __future__ import annotations

import hashlib
import json
import re
import threading
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from docloom.functions.convert import document_schema
from docloom.model import IndexDef, IndexSet
from docloom.operators.snapshots import SnapshotTable
from docloom.operators.store import COMMON_COLUMNS, TARGET_BUCKET_ROWS, DocumentTable
from docloom.plans import views
from docloom.sources.tables import union_tenants
from docloom.workspace import local_frame

#: Views made at once; each has its files listed.
PARALLEL_VIEWS = 4
#: Names that the catalog takes.
CATALOG_NAME = re.compile("[A-Za-z0-9_]+")
#: Property of a view: digest of its query.
VIEW_DIGEST = "docloom.query"

MAPPING_SCHEMA = T.StructType([T.StructField("fields", T.StringType())])


class DocumentIndex:
    """All document tables of an index set."""

    def __init__(
        self, spark: SparkSession, index_set: IndexSet, root: str, target_rows: int = TARGET_BUCKET_ROWS
    ):
        self.spark = spark
        self.index_set = index_set
        self.path = f"{root.rstrip('/')}/{index_set.parent_index}"
        self.target_rows = target_rows
        self._tables: dict[str, DocumentTable] = {}
        self._opening = threading.Lock()

    def table(self, document_type: str) -> DocumentTable:
        index = self.index_set.find(document_type)
        with self._opening:
            if index.document_type not in self._tables:
                self._tables[index.document_type] = DocumentTable(
                    self.spark, self.path, index.document_type, self.put_mapping(index), self.target_rows
                )
            return self._tables[index.document_type]

    def put_mapping(self, index: IndexDef) -> T.StructType:
        """Store the declared fields of a type unless it has some; returns those in force.

        The first mapping stays: data already written has its types.  A type marked to be
        skipped stores none and follows its definition.
        """
        declared = document_schema(index.mapping, index.mappers)
        stored = SnapshotTable(self.spark, f"{self.path}/{index.document_type}/mapping", MAPPING_SCHEMA)
        if stored.current_path() is not None:
            return T.StructType.fromJson(json.loads(stored.read().first().fields))
        if not index.skip_creation:
            stored.write(local_frame(self.spark, [(declared.json(),)], MAPPING_SCHEMA))
        return declared

    def create(self) -> list[str]:
        """Create the tables that are missing, except those marked to be skipped."""
        return [
            index.document_type
            for index in self.index_set.indexes
            if not index.skip_creation and self.table(index.document_type).create()
        ]

    def drop(self, types: str | None = None) -> bool:
        """Remove the tables of all or some types; True when they are gone."""
        gone = True
        for index in self.index_set.select(types):
            gone = self.table(index.document_type).drop() and gone
            del self._tables[index.document_type]
        return gone

    def documents(self, types: Sequence[str] | None = None) -> DataFrame:
        """Live documents of all (or some) types, common columns only."""
        kinds = self.index_set.types() if types is None else list(types)
        return union_tenants(
            [self.table(kind).documents().select(*COMMON_COLUMNS) for kind in kinds]
        )

    # ---------------------------------------------------------------- views

    def create_alias(self, name: str, tenant: str | None = None) -> None:
        """A view of the documents, of one tenant if given, that follows the tables.

        Every session of the catalog can read it, and sees what is stored when it reads.  A name that
        the catalog does not take (other than letters, digits and ``_``) gives a view of this session.
        """
        self._put_view(name, views.documents_sql(self._readable(), tenant))

    def create_tenant_aliases(self, tenants: Sequence[str]) -> None:
        """A view per tenant, under the tenant's name; those that are there already stay."""
        tables = self._readable()
        with ThreadPoolExecutor(max_workers=PARALLEL_VIEWS) as pool:
            list(pool.map(lambda tenant: self._put_view(tenant, views.documents_sql(tables, tenant)), tenants))

    def _readable(self) -> list[DocumentTable]:
        return [table for table in map(self.table, self.index_set.types()) if views.make_readable(table)]

    def _put_view(self, name: str, query: str) -> None:
        """Make a view, unless there is one with this query."""
        view = "`" + name.replace("`", "``") + "`"
        digest = hashlib.sha256(query.encode()).hexdigest()
        self.spark.catalog.dropTempView(name)
        if not CATALOG_NAME.fullmatch(name):
            self.spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} AS {query}")
            return
        if self.spark.catalog.tableExists(view):
            stored = {row.key: row.value for row in self.spark.sql(f"SHOW TBLPROPERTIES {view}").collect()}
            if stored.get(VIEW_DIGEST) == digest:
                return
        self.spark.sql(f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('{VIEW_DIGEST}' = '{digest}') AS {query}")

    def alias_exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(f"`{name}`")

    def drop_alias(self, name: str) -> bool:
        """Remove a view; True when there was one."""
        found = self.alias_exists(name)
        if found and not self.spark.catalog.dropTempView(name):
            self.spark.sql(f"DROP VIEW `{name}`")
        return found
