"""Aggregations, windows and change-event operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.operators import changes as ch
from docloom.operators import state as st
from docloom.sources.tables import query_rows
from docloom.suite import base as b

suite = b.Suite()

CLASSIFIED_SQL = f"""(SELECT tenant_id AS tenant, lower(trim(object_code)) AS document_type,
  object_id, event_time, seq, operation_type,
  CASE WHEN lower(operation_type) IN ('create', 'update', 'access_changed_group') THEN 'update'
       WHEN lower(operation_type) = 'delete' THEN 'delete'
       WHEN lower(operation_type) = 'bulkupdate' THEN 'bulk_update'
       WHEN lower(operation_type) = 'bulkdelete' THEN 'bulk_delete'
       WHEN lower(operation_type) = 'slicedeprovisioned' THEN 'deprovision' END AS action
  FROM ({b.for_sql(b.BULK_CHANGES)}) c)"""

USABLE_SQL = f"""(SELECT * FROM {CLASSIFIED_SQL} k WHERE action IS NOT NULL
  AND NOT (action IN ('update', 'delete') AND object_id IS NULL))"""

FLAGS_SQL = f"""(SELECT tenant, document_type, bool_or(action = 'bulk_update') AS bulk_update,
  bool_or(action = 'bulk_delete') AS bulk_delete, bool_or(action = 'deprovision') AS deprovision
  FROM {USABLE_SQL} u GROUP BY tenant, document_type)"""


def usable_changes(spark, folder):
    return ch.split_problems(ch.classify(b.changes(spark, folder, b.BULK_CHANGES)))[0]


@suite.add(
    "max_event_time",
    f"SELECT tenant_id, max(event_time) AS max_event_time FROM ({b.for_sql(b.CHANGES)}) c GROUP BY tenant_id",
)
def max_event_time(spark, folder):
    return ch.max_event_time(b.changes(spark, folder))


@suite.add(
    "group_changes_by_type",
    f"""SELECT tenant_id, object_code, count(*) AS changes FROM ({b.for_sql(b.CHANGES)}) c
        GROUP BY tenant_id, object_code""",
)
def group_changes_by_type(spark, folder):
    return ch.changes_by_type(b.changes(spark, folder))


@suite.add("bulk_flags", f"SELECT * FROM {FLAGS_SQL} f")
def bulk_flags(spark, folder):
    return ch.bulk_flags(usable_changes(spark, folder))


@suite.add(
    "count_hits",
    f"SELECT tenant, document_type, count(*) AS hits FROM {b.ALL_DOCS_SQL} d GROUP BY tenant, document_type",
)
def count_hits(spark, folder):
    documents = b.all_documents(spark, folder)
    return documents.groupBy("tenant", "document_type").agg(F.count(F.lit(1)).alias("hits"))


@suite.add(
    "any_tenant_eligible",
    f"""SELECT tenant, bool_or(last_index_type IS NOT NULL AND lower(status) = 'completed') AS eligible
        FROM ({b.for_sql(b.STATE)}) s GROUP BY tenant""",
)
def any_tenant_eligible(spark, folder):
    return st.tenant_eligibility(b.states(spark, folder))


AGGREGATE = """
SELECT l_returnflag, l_linestatus, count(*) AS line_count, count(DISTINCT l_suppkey) AS suppliers,
       max(l_quantity) AS max_quantity, grouping(l_returnflag) + 2 * grouping(l_linestatus) AS level
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00'
GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())"""


@suite.add(
    "index_query_aggregate",
    f"""SELECT l_returnflag, l_linestatus, line_count, suppliers, max_quantity, CAST(level AS BIGINT) AS level
        FROM ({AGGREGATE}) g""",
)
def index_query_aggregate(spark, folder):
    b.register_tables(spark, folder, "lineitem")
    return query_rows(spark, AGGREGATE).withColumn("level", F.col("level").cast("bigint"))


WINDOW = """
SELECT o_orderkey, o_custkey, CAST(rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS BIGINT) AS price_rank,
       lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous_order
FROM orders"""


@suite.add("index_query_window", WINDOW)
def index_query_window(spark, folder):
    b.register_tables(spark, folder, "orders")
    return query_rows(spark, WINDOW)


@suite.add(
    "dedupe_changes_latest",
    f"""SELECT tenant, document_type, object_id, operation_type, event_time, seq FROM (
          SELECT tenant_id AS tenant, object_code AS document_type, object_id, operation_type, event_time, seq,
                 row_number() OVER (PARTITION BY tenant_id, object_code, object_id
                                    ORDER BY event_time DESC, seq DESC) AS rn
          FROM ({b.for_sql(b.CHANGES)}) c) r WHERE rn = 1""",
)
def dedupe_changes_latest(spark, folder):
    latest = ch.latest_change(ch.classify(b.changes(spark, folder)))
    return latest.select("tenant", "document_type", "object_id", "operation_type", "event_time", "seq")


@suite.add(
    "parse_changes",
    f"""SELECT tenant_id, object_code, operation_type, object_id, event_time, seq,
               seq % 7 = 0 OR object_id IS NULL AS unusable
        FROM (SELECT CASE WHEN seq % 7 <> 0 THEN tenant_id END AS tenant_id,
                     CASE WHEN seq % 7 <> 0 THEN object_code END AS object_code,
                     CASE WHEN seq % 7 <> 0 THEN operation_type END AS operation_type,
                     CASE WHEN seq % 7 <> 0 THEN object_id END AS object_id, event_time, seq
              FROM ({b.for_sql(b.CHANGES)}) c) p""",
)
def parse_changes(spark, folder):
    """Messages, every seventh of them cut short; ids are written as text by every fifth."""
    log = b.changes(spark, folder)
    whole = F.to_json(F.struct("tenant_id", "object_code", "operation_type", "object_id"))
    quoted = F.to_json(
        F.struct("tenant_id", "object_code", "operation_type", F.col("object_id").cast("string").alias("object_id"))
    )
    message = F.when(F.col("seq") % 7 == 0, F.substring(whole, 1, 9)).when(F.col("seq") % 5 == 0, quoted).otherwise(whole)
    parsed = ch.classify(ch.parse_messages(log.select(message.alias("value"), "event_time", "seq")))
    return parsed.select(*ch.CHANGE_SCHEMA.names, F.col("problem").isNotNull().alias("unusable"))


@suite.add(
    "classify_change",
    f"""SELECT seq, tenant, document_type, action,
               CASE WHEN action IS NULL THEN 'unknown operation'
                    WHEN action IN ('update', 'delete') AND object_id IS NULL THEN 'no object id' END AS problem
        FROM {CLASSIFIED_SQL} k""",
)
def classify_change(spark, folder):
    classified = ch.classify(b.changes(spark, folder, b.BULK_CHANGES))
    return classified.select("seq", "tenant", "document_type", "action", "problem")


@suite.add(
    "override_bulk",
    f"""SELECT tenant, document_type, object_id, seq, 'item' AS outcome FROM {USABLE_SQL} u
        WHERE action IN ('update', 'delete')
          AND tenant NOT IN (SELECT tenant FROM {FLAGS_SQL} f WHERE deprovision)
          AND NOT EXISTS (SELECT 1 FROM {FLAGS_SQL} f WHERE f.tenant = u.tenant
                          AND f.document_type = u.document_type AND (bulk_update OR bulk_delete))
        UNION ALL SELECT tenant, document_type, NULL, NULL, 'delete type' FROM {FLAGS_SQL} f WHERE bulk_delete
          AND tenant NOT IN (SELECT tenant FROM {FLAGS_SQL} g WHERE deprovision)
        UNION ALL SELECT DISTINCT tenant, NULL, NULL, NULL, 'remove tenant' FROM {FLAGS_SQL} f WHERE deprovision""",
)
def override_bulk(spark, folder):
    items, deleted, removed = ch.override_bulk(usable_changes(spark, folder))
    parts = items.select("tenant", "document_type", "object_id", "seq", F.lit("item").alias("outcome"))
    parts = parts.unionByName(deleted.withColumn("outcome", F.lit("delete type")), True)
    return parts.unionByName(removed.withColumn("outcome", F.lit("remove tenant")), True)


@suite.add(
    "split_update_delete",
    f"""SELECT seq, object_id, CASE WHEN operation_type = 'DELETE' THEN 'delete' ELSE 'update' END AS side
        FROM ({b.for_sql(b.CHANGES)}) c""",
)
def split_update_delete(spark, folder):
    updates, deletes = ch.split_update_delete(ch.classify(b.changes(spark, folder)))
    sides = (updates.withColumn("side", F.lit("update")), deletes.withColumn("side", F.lit("delete")))
    return sides[0].unionByName(sides[1]).select("seq", "object_id", "side")


@suite.add(
    "purge_change_log",
    f"""SELECT * FROM ({b.for_sql(b.CHANGES)}) c
        WHERE tenant_id NOT IN (SELECT tenant FROM {b.ELIGIBLE_SQL} e)""",
)
def purge_change_log(spark, folder):
    """Rows of tenants with a completed type are taken, also those of other types."""
    log = b.changes(spark, folder)
    eligible = st.tenant_eligibility(b.few_states(spark)).where("eligible")
    read = log.join(eligible, F.col("tenant_id") == F.col("tenant"), "left_semi")
    return ch.purge(log, read)
