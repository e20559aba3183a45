"""Lookups and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.operators import changes as ch
from docloom.operators import state as st
from docloom.operators import store
from docloom.plans.documents import to_documents
from docloom.sources.tables import query_rows
from docloom.suite import base as b

suite = b.Suite()

CUSTOMER_TYPES_SQL = f"""(SELECT t.tenant, t.enabled, k.document_type FROM ({b.TENANTS}) t
   CROSS JOIN (VALUES ('customer'), ('event'), ('order')) k(document_type))"""


@suite.add(
    "join_last_run",
    f"""SELECT p.tenant, p.document_type,
               CASE WHEN s.status = 'Deleted' THEN 0 ELSE coalesce(s.last_indexed_at, 0) END AS last_run
        FROM {CUSTOMER_TYPES_SQL} p LEFT JOIN ({b.for_sql(b.STATE)}) s
          ON p.tenant = s.tenant AND p.document_type = s.document_type""",
)
def join_last_run(spark, folder):
    kinds = F.explode(F.array(*[F.lit(kind) for kind in ("customer", "event", "order")]))
    pairs = b.customer_tenants(spark, folder).select("tenant", kinds.alias("document_type"))
    return st.last_run(pairs, b.states(spark, folder))


@suite.add(
    "join_tenant_app",
    f"""SELECT s.tenant, s.document_type, s.status, coalesce(t.app_id, s.appid) AS appid
        FROM ({b.for_sql(b.STATE)}) s LEFT JOIN ({b.TENANTS}) t ON s.tenant = t.tenant""",
)
def join_tenant_app(spark, folder):
    enriched = st.with_app(b.states(spark, folder), b.customer_tenants(spark, folder))
    return enriched.select("tenant", "document_type", "status", "appid")


@suite.add(
    "semi_eligible_changes",
    f"""SELECT c.tenant_id AS tenant, lower(c.object_code) AS document_type, c.object_id, c.seq
        FROM ({b.for_sql(b.CHANGES)}) c WHERE EXISTS (SELECT 1 FROM {b.ELIGIBLE_SQL} e
          WHERE e.tenant = c.tenant_id AND e.document_type = lower(c.object_code))""",
)
def semi_eligible_changes(spark, folder):
    classified = ch.classify(b.changes(spark, folder))
    found = ch.eligible_changes(classified, st.completed(b.few_states(spark)))
    return found.select("tenant", "document_type", "object_id", "seq")


@suite.add(
    "anti_existing",
    f"""SELECT doc_id FROM {b.ALL_DOCS_SQL} d WHERE document_type = 'order' AND doc_id NOT IN (
          SELECT 'tenant' || (l_orderkey % 4) || '_order_' || l_orderkey FROM lineitem WHERE l_returnflag = 'A')""",
)
def anti_existing(spark, folder):
    documents = to_documents(b.rows_of(spark, folder, b.ORDER, "orders"), b.ORDER)
    replaced = b.table(spark, folder, "lineitem").where("l_returnflag = 'A'").selectExpr(
        "'tenant' || (l_orderkey % 4) || '_order_' || l_orderkey AS doc_id"
    )
    return store.without(documents, replaced).select("doc_id")


@suite.add(
    "status_inventory",
    f"""SELECT p.tenant, p.enabled, p.document_type, coalesce(s.status, 'Not Run') AS status,
               s.last_index_type, s.last_indexed_at, s.execution_started_at
        FROM {CUSTOMER_TYPES_SQL} p LEFT JOIN ({b.for_sql(b.STATE)}) s
          ON p.tenant = s.tenant AND p.document_type = s.document_type
        WHERE p.enabled AND lower(coalesce(s.status, 'Not Run')) = 'not run'""",
)
def status_inventory(spark, folder):
    return st.status_inventory(
        b.customer_tenants(spark, folder),
        ["customer", "event", "order"],
        b.states(spark, folder),
        enabled="true",
        status="not run",
    )


@suite.add(
    "children_with_parent",
    """SELECT 'tenant' || (conv_id % 4) || '_conversation_' || (conv_id * 1000 + turn) AS child,
              'tenant' || (conv_id % 4) || '_project_' || c_custkey AS parent, c_name
       FROM conversations JOIN customer ON c_custkey = conv_id""",
)
def children_with_parent(spark, folder):
    """Conversations under the project of the same number (projects made from customers)."""
    children = to_documents(
        b.rows_of(spark, folder, b.CONVERSATION, "conversations"), b.CONVERSATION
    )
    projects = b.table(spark, folder, "customer").selectExpr(
        "'tenant' || (c_custkey % 4) || '_project_' || c_custkey AS parent", "c_name"
    )
    return children.join(projects, F.col("parent_key") == F.col("parent")).select(
        F.col("doc_id").alias("child"), "parent", "c_name"
    )


JOIN = """
SELECT n_name, r_name, c_custkey, count(*) AS orders_placed, min(o_orderdate) AS first_order
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
     JOIN orders ON o_custkey = c_custkey AND o_totalprice > 100 * c_acctbal / 10
GROUP BY n_name, r_name, c_custkey"""


@suite.add("index_query_join", JOIN)
def index_query_join(spark, folder):
    b.register_tables(spark, folder, "customer", "nation", "region", "orders")
    return query_rows(spark, JOIN)


@suite.add(
    "guard_running",
    f"""SELECT tenant, document_type FROM {CUSTOMER_TYPES_SQL} p WHERE NOT EXISTS (
          SELECT 1 FROM ({b.for_sql(b.STATE)}) s
          WHERE s.tenant = p.tenant AND s.document_type = p.document_type AND s.status = 'Running')""",
)
def guard_running(spark, folder):
    kinds = F.explode(F.array(*[F.lit(kind) for kind in ("customer", "event", "order")]))
    pairs = b.customer_tenants(spark, folder).select("tenant", kinds.alias("document_type"))
    return st.not_running(pairs, b.states(spark, folder)).select("tenant", "document_type")

