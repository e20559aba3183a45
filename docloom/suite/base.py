"""Registry and shared inputs of the query suite.

Inputs derived from the supplied tables are SQL texts that both engines run, with the
few functions they spell differently filled in per engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.model import IndexDef, IndexSet, ParentLink, Tenant
from docloom.operators import state as st
from docloom.plans.catalog import DocumentIndex
from docloom.plans.indexer import Indexer
from docloom.sources.tables import SharedTables, query_rows
from docloom.workspace import fresh_path, local_frame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


class Suite:
    """Queries of one module and the SQL they are compared with."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracle: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None):
        def register(fn: Callable[[SparkSession, str], DataFrame]):
            def run(spark: SparkSession, folder: str) -> DataFrame:
                spark.conf.set("spark.sql.session.timeZone", "UTC")
                return fn(spark, folder)

            self.queries[name] = run
            if sql is not None:
                self.oracle[name] = sql
            return fn

        return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def register_tables(spark: SparkSession, folder: str, *names: str) -> None:
    for name in names or TABLES:
        table(spark, folder, name).createOrReplaceTempView(name)


# -------------------------------------------------------------------- derived inputs

SPARK = {"epoch": "unix_seconds(CAST({} AS timestamp))"}
SQL = {"epoch": "CAST(floor(epoch({})) AS BIGINT)"}


def _fill(text: str, dialect: dict[str, str]) -> str:
    for column in ("ts", "o_orderdate"):
        text = text.replace(f"EPOCH({column})", dialect["epoch"].format(column))
    return text


def for_sql(text: str) -> str:
    return _fill(text, SQL)


def for_spark(text: str) -> str:
    return _fill(text, SPARK)


def derived(spark: SparkSession, folder: str, text: str, *names: str) -> DataFrame:
    """An input text run on Spark over the named tables."""
    register_tables(spark, folder, *names)
    return spark.sql(for_spark(text))


#: Change log rows made from the event stream; event_id breaks ties.
CHANGES = """
SELECT 'tenant' || (user_id % 4) AS tenant_id,
       CASE event_id % 3 WHEN 0 THEN 'customer' WHEN 1 THEN 'order' ELSE 'ghost' END AS object_code,
       CASE event_type WHEN 'signup' THEN 'CREATE' WHEN 'view' THEN 'UPDATE' WHEN 'click' THEN 'Update'
            WHEN 'purchase' THEN 'ACCESS_CHANGED_GROUP' ELSE 'DELETE' END AS operation_type,
       user_id AS object_id,
       EPOCH(ts) AS event_time,
       event_id AS seq
FROM events"""

#: The same log with some operations replaced: bulk ones, a deprovision and an unknown one.
BULK_CHANGES = """
SELECT 'tenant' || (user_id % 4) AS tenant_id,
       CASE event_id % 3 WHEN 0 THEN 'customer' WHEN 1 THEN 'Order' ELSE 'ghost' END AS object_code,
       CASE WHEN event_id % 50 = 1 AND user_id % 4 = 1 AND event_id % 3 = 1 THEN 'BULKDELETE'
            WHEN event_id % 50 = 2 AND user_id % 4 = 0 AND event_id % 3 = 1 THEN 'BulkUpdate'
            WHEN event_id % 50 = 3 AND user_id % 4 = 2 THEN 'SliceDeprovisioned'
            WHEN event_id % 50 = 4 THEN 'REPAINT'
            WHEN event_type = 'error' THEN 'DELETE'
            WHEN event_type = 'signup' THEN 'CREATE'
            ELSE 'UPDATE' END AS operation_type,
       CASE WHEN event_id % 50 = 5 THEN NULL ELSE user_id END AS object_id,
       EPOCH(ts) AS event_time,
       event_id AS seq
FROM events"""

#: Tenants made from customers, one each.
TENANTS = """
SELECT 'cust' || c_custkey AS tenant, 'app' || c_nationkey AS app_id, c_mktsegment AS bg_id,
       c_acctbal >= 5000 AS enabled
FROM customer"""

#: Run state made from orders: one record per customer tenant and document type.
STATE = """
SELECT tenant, appid, document_type, execution_started_at, last_indexed_at,
       CASE CAST(floor(last_key / 7) AS BIGINT) % 4 WHEN 0 THEN 'Full' WHEN 1 THEN 'Incremental' WHEN 2 THEN 'Selective' END
           AS last_index_type,
       CASE CAST(floor(last_key / 3) AS BIGINT) % 6 WHEN 0 THEN 'Not Run' WHEN 1 THEN 'Scheduled' WHEN 2 THEN 'Running'
            WHEN 3 THEN 'Completed' WHEN 4 THEN 'Failed' ELSE 'Deleted' END AS status
FROM (SELECT 'cust' || o_custkey AS tenant,
             'app' || (o_custkey % 25) AS appid,
             CASE o_orderkey % 3 WHEN 0 THEN 'order' WHEN 1 THEN 'customer' ELSE 'event' END
                 AS document_type,
             min(EPOCH(o_orderdate)) AS execution_started_at,
             max(EPOCH(o_orderdate)) AS last_indexed_at,
             max(o_orderkey) AS last_key
      FROM orders GROUP BY 1, 2, 3) s"""

#: Run state of the four event tenants.
FEW_STATES = [
    ("tenant0", "order", "Full", "Completed"),
    ("tenant0", "customer", None, "Completed"),
    ("tenant1", "Customer", "Incremental", "completed"),
    ("tenant1", "order", "Full", "Deleted"),
    ("tenant2", "order", "Full", "Running"),
]

FEW_STATES_SQL = """(VALUES ('tenant0', 'order', 'Full', 'Completed'),
  ('tenant0', 'customer', NULL, 'Completed'),
  ('tenant1', 'Customer', 'Incremental', 'completed'),
  ('tenant1', 'order', 'Full', 'Deleted'),
  ('tenant2', 'order', 'Full', 'Running')) s(tenant, document_type, last_index_type, status)"""

#: Eligible (tenant, type) pairs that follow from the rows above.
ELIGIBLE_SQL = f"""(SELECT DISTINCT tenant, lower(document_type) AS document_type FROM {FEW_STATES_SQL}
  WHERE last_index_type IS NOT NULL AND lower(status) = 'completed')"""


def changes(spark: SparkSession, folder: str, text: str = CHANGES) -> DataFrame:
    return derived(spark, folder, text, "events")


def states(spark: SparkSession, folder: str) -> DataFrame:
    return derived(spark, folder, STATE, "orders")


def customer_tenants(spark: SparkSession, folder: str) -> DataFrame:
    return derived(spark, folder, TENANTS, "customer")


def few_states(spark: SparkSession) -> DataFrame:
    return local_frame(
        spark,
        FEW_STATES,
        "tenant string, document_type string, last_index_type string, status string",
    )


# -------------------------------------------------------------------- index definitions

FOUR_TENANTS = (
    Tenant("tenant0", "app0"),
    Tenant("tenant1", "app1"),
    Tenant("tenant2", "app2"),
    Tenant("tenant3", "app3", enabled=False),
    Tenant("tenant0", "app9"),
)
ENABLED = ("tenant0", "tenant1", "tenant2")

ORDER = IndexDef(
    document_type="order",
    queries={
        "spark": """SELECT 'tenant' || (o_orderkey % 4) AS tenant, o_orderkey, o_custkey, o_orderstatus,
                           o_totalprice, o_orderdate, o_orderpriority FROM orders"""
    },
    id_key="o_orderkey",
    modified_key="o_orderdate",
    mapping={
        "o_orderkey": {"type": "long"},
        "o_custkey": {"type": "long"},
        "o_orderstatus": {"type": "keyword"},
        "o_orderpriority": {"type": "text"},
        "o_totalprice": {"type": "double"},
        "o_orderdate": {"type": "date", "format": "epoch_second"},
    },
)

CUSTOMER = IndexDef(
    document_type="customer",
    queries={
        "spark": """SELECT 'tenant' || (c_custkey % 4) AS tenant, c_custkey, c_name, c_nationkey,
                           c_acctbal, c_mktsegment FROM customer"""
    },
    id_key="c.c_custkey",
    mapping={
        "c_custkey": {"type": "long"},
        "c_name": {"type": "text"},
        "c_nationkey": {"type": "long"},
        "c_mktsegment": {"type": "keyword"},
    },
)

CONVERSATION = IndexDef(
    document_type="conversation",
    queries={
        "spark": """SELECT 'tenant' || (conv_id % 4) AS tenant, conv_id * 1000 + turn AS row_id,
                           conv_id AS resource_id, role, text FROM conversations"""
    },
    mapping={"resource_id": {"type": "long"}, "role": {"type": "keyword"}, "text": {"type": "text"}},
    parent=ParentLink("project", "resource_id"),
)

DOCUMENT = IndexDef(
    document_type="document",
    queries={"spark": "SELECT 'tenant' || (doc_id % 4) AS tenant, doc_id, text, lang FROM documents"},
    id_key="doc_id",
    mapping={"text": {"type": "text"}, "lang": {"type": "keyword"}},
)

INDEX_SET = IndexSet((ORDER, CUSTOMER))

#: (tenant, document_type, doc_id) of every order and customer row.
ALL_DOCS_SQL = """(SELECT 'tenant' || (o_orderkey % 4) AS tenant, 'order' AS document_type,
         'tenant' || (o_orderkey % 4) || '_order_' || o_orderkey AS doc_id FROM orders
  UNION ALL
  SELECT 'tenant' || (c_custkey % 4), 'customer',
         'tenant' || (c_custkey % 4) || '_customer_' || c_custkey FROM customer)"""

OLD_ORDERS = """SELECT o_orderkey, o_custkey, 'OLD' AS o_orderstatus, o_totalprice, o_orderdate,
                       o_orderpriority FROM orders_now"""


def rows_of(spark: SparkSession, folder: str, index: IndexDef, *names: str) -> DataFrame:
    register_tables(spark, folder, *names)
    return query_rows(spark, index.query_for(None))


#: Index of all tenants per session and folder, so that reading queries share one full run.
_STORED: dict[tuple[str, str], Indexer] = {}


def all_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and customers as a full run has stored them, for all four tenants."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _STORED:
        register_tables(spark, folder, "orders", "customer")
        tenants = [Tenant(f"tenant{number}") for number in range(4)]
        jobs = Indexer(spark, INDEX_SET, tenants, SharedTables(spark), fresh_path(spark, "stored"))
        jobs.full(run_ts=1)
        _STORED[key] = jobs
    return _STORED[key].index.documents()


def indexer(spark: SparkSession, folder: str, index_set: IndexSet = INDEX_SET) -> Indexer:
    """An indexer over the supplied tables with an empty index of its own."""
    register_tables(spark, folder, "orders", "customer", "conversations", "documents")
    return Indexer(
        spark, index_set, FOUR_TENANTS, SharedTables(spark), fresh_path(spark, "index")
    )


def index_of_old_orders(spark: SparkSession, folder: str, run_ts: int) -> Indexer:
    """An indexed set whose source has moved on since: every order was OLD when indexed."""
    jobs = indexer(spark, folder)
    table(spark, folder, "orders").createOrReplaceTempView("orders_now")
    spark.sql(OLD_ORDERS).createOrReplaceTempView("orders")
    jobs.full(run_ts=run_ts)
    table(spark, folder, "orders").createOrReplaceTempView("orders")
    return jobs


def store_state(spark: SparkSession, records: DataFrame) -> st.RunState:
    """A stored state table holding the given records."""
    state = st.RunState(spark, fresh_path(spark, "state"))
    state.update(records)
    return state
