"""Configuration objects: tenants, index definitions, mappings."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.workspace import local_frame

# Defaults and limits a user of index sets relies on.
DEFAULT_ID_KEY = "row_id"
DEFAULT_MODIFIED_KEY = "MODIFIED_DATE"
DEFAULT_BATCH_COUNT = 10_000
MAX_BATCH_COUNT = 500_000

# Run modes.
FULL, INCREMENTAL, SELECTIVE = "Full", "Incremental", "Selective"

# Run status.
NOT_RUN, SCHEDULED, RUNNING = "Not Run", "Scheduled", "Running"
COMPLETED, FAILED, DELETED = "Completed", "Failed", "Deleted"
STATUSES = (NOT_RUN, SCHEDULED, RUNNING, COMPLETED, FAILED, DELETED)

# Declared field types of a mapping.
MAPPING_TYPES = {
    "keyword": T.StringType(),
    "text": T.StringType(),
    "long": T.LongType(),
    "integer": T.IntegerType(),
    "short": T.ShortType(),
    "byte": T.ByteType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "binary": T.StringType(),
    "date": T.TimestampType(),
}

TENANT_SCHEMA = T.StructType(
    [
        T.StructField("ordinal", T.IntegerType(), False),
        T.StructField("tenant", T.StringType(), False),
        T.StructField("app_id", T.StringType()),
        T.StructField("bg_id", T.StringType()),
        T.StructField("enabled", T.BooleanType(), False),
        T.StructField("vendor", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Tenant:
    """One tenant; ``source`` holds the options of its data source."""

    id: str
    app_id: str | None = None
    bg_id: str | None = None
    enabled: bool = True
    vendor: str | None = None
    source: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class ParentLink:
    """Parent of a document: ``<tenant>_<parent_type>_<value of column>``."""

    parent_type: str
    column: str


@dataclass(frozen=True)
class IndexDef:
    """A document type and the query that produces its rows.

    ``queries`` maps a vendor name to a text; the first entry is the default.
    ``mapping`` maps field names to ``{"type": ..., "format": ...}``.
    ``mappers`` maps a column name to the name of a registered column mapper.
    """

    document_type: str
    queries: Mapping[str, str]
    id_key: str | None = None
    modified_key: str | None = None
    mapping: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    mappers: Mapping[str, str] = field(default_factory=dict)
    parent: ParentLink | None = None
    skip_creation: bool = False
    #: Kept for earlier definitions: every run stages its rows now.
    stage_rows: bool = False

    @property
    def id_column(self) -> str:
        return (self.id_key or "").strip() or DEFAULT_ID_KEY

    @property
    def modified_column(self) -> str:
        return (self.modified_key or "").strip() or DEFAULT_MODIFIED_KEY

    def query_for(self, vendor: str | None) -> str:
        """Text for a vendor (case-insensitive), else the default text."""
        for name, text in self.queries.items():
            if vendor is not None and name.lower() == vendor.lower():
                return text
        return next(iter(self.queries.values()))


@dataclass(frozen=True)
class IndexSet:
    """Index definitions that share one parent index."""

    indexes: tuple[IndexDef, ...]
    parent_index: str = "documents"
    batch_count: int = DEFAULT_BATCH_COUNT
    delete_records_after_indexing: bool = True

    def effective_batch_count(self) -> int:
        return clamp_batch_count(self.batch_count)

    def types(self) -> list[str]:
        return [index.document_type for index in self.indexes]

    def find(self, document_type: str) -> IndexDef:
        for index in self.indexes:
            if index.document_type.lower() == document_type.strip().lower():
                return index
        raise KeyError(f"no index definition for document type {document_type!r}")

    def select(self, type_list: str | None) -> list[IndexDef]:
        """Definitions named in a comma list; ``None`` selects all."""
        if type_list is None:
            return list(self.indexes)
        wanted = {part.strip().lower() for part in type_list.split(",")}
        return [index for index in self.indexes if index.document_type.lower() in wanted]


def clamp_batch_count(value: int) -> int:
    return value if 1 <= value <= MAX_BATCH_COUNT else DEFAULT_BATCH_COUNT


def read_mapping(text: str) -> dict[str, dict[str, dict[str, str]]]:
    """Mapping JSON, one type or several, to ``{type: {field: {...}}}``."""
    return {name: dict(body.get("properties", {})) for name, body in json.loads(text).items()}


def is_epoch_field(spec: Mapping[str, str]) -> bool:
    return spec.get("type") == "date" and spec.get("format") == "epoch_second"


def mapping_type(spec: Mapping[str, str]) -> T.DataType:
    if is_epoch_field(spec):
        return T.LongType()
    try:
        return MAPPING_TYPES[spec["type"]]
    except KeyError:
        raise ValueError(f"unknown mapping type {spec.get('type')!r}") from None


def tenants_frame(spark: SparkSession, tenants: Iterable[Tenant]) -> DataFrame:
    """Tenant configuration as a DataFrame, in definition order."""
    rows = [
        (ordinal, t.id, t.app_id, t.bg_id, t.enabled, t.vendor)
        for ordinal, t in enumerate(tenants)
    ]
    return local_frame(spark, rows, TENANT_SCHEMA)


def dedupe_tenants(tenants: DataFrame, key: str = "tenant", order: str = "ordinal") -> tuple[DataFrame, DataFrame]:
    """(first definition of each tenant, the definitions that lost); ``order`` is unique.

    The minimum is combined before the shuffle, so a tenant defined very often is no
    burden on one task.
    """
    firsts = tenants.groupBy(key).agg(F.min(order).alias("_first"))
    marked = tenants.join(firsts, key)
    kept = F.col(order) == F.col("_first")
    return marked.where(kept).drop("_first"), marked.where(~kept).drop("_first")
