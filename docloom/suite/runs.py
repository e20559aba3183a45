"""The four run modes and the change pipeline, end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.operators import changes as ch
from docloom.suite import base as b
from docloom.suite.aggregates import FLAGS_SQL, USABLE_SQL
from docloom.workspace import stage

suite = b.Suite()

#: 1998-01-01, the mark the incremental run starts from.
MARK = 883_612_800

ORDERS_SQL = """SELECT 'tenant' || (o_orderkey % 4) AS tenant,
  'tenant' || (o_orderkey % 4) || '_order_' || o_orderkey AS doc_id"""


def order_status(jobs):
    return jobs.index.table("order").typed().select("tenant", "doc_id", "o_orderstatus")


@suite.add(
    "full_index",
    f"""{ORDERS_SQL}, 'order' AS document_type, o_orderkey AS key, o_custkey AS other, o_orderstatus AS kind,
          o_orderpriority AS name, o_totalprice AS amount, CAST(floor(epoch(o_orderdate)) AS BIGINT) AS day,
          o_orderkey AS in_key, o_custkey AS in_other, o_orderstatus AS in_kind, o_orderpriority AS in_name,
          o_totalprice AS in_amount, CAST(floor(epoch(o_orderdate)) AS BIGINT) AS in_day
        FROM orders WHERE o_orderkey % 4 < 3
        UNION ALL
        SELECT 'tenant' || (c_custkey % 4), 'tenant' || (c_custkey % 4) || '_customer_' || c_custkey, 'customer',
          c_custkey, c_nationkey, c_mktsegment, c_name, NULL, NULL,
          c_custkey, c_nationkey, c_mktsegment, c_name, c_acctbal, NULL
        FROM customer WHERE c_custkey % 4 < 3""",
)
def full_index(spark, folder):
    """Every typed field of the stored documents, and every value of their stored source."""
    jobs = b.indexer(spark, folder)
    jobs.full(run_ts=MARK)
    kinds = {"key": "bigint", "other": "bigint", "kind": "string", "name": "string", "amount": "double", "day": "bigint"}
    orders = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate")
    customers = ("c_custkey", "c_nationkey", "c_mktsegment", "c_name", None, None)
    customers_in = ("c_custkey", "c_nationkey", "c_mktsegment", "c_name", "c_acctbal", None)

    def read(document_type, typed, stored):
        columns = []
        for (name, kind), field, inside in zip(kinds.items(), typed, stored):
            value = F.lit(None) if field is None else F.col(f"doc.{field}")
            text = F.lit(None) if inside is None else F.get_json_object("source", f"$.{inside}")
            if kind == "bigint" and name == "day" and field is not None:
                value = F.unix_seconds(value.cast("timestamp"))
            columns += [value.cast(kind).alias(name), text.cast(kind).alias(f"in_{name}")]
        return jobs.index.table(document_type).documents().select("tenant", "document_type", "doc_id", *columns)

    return read("order", orders, orders).unionByName(read("customer", customers, customers_in))


@suite.add(
    "incremental_index",
    f"""{ORDERS_SQL}, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' OR o_orderkey % 4 = 1
              THEN o_orderstatus ELSE 'OLD' END AS o_orderstatus
        FROM orders WHERE o_orderkey % 4 < 3""",
)
def incremental_index(spark, folder):
    """Rows changed since the mark; tenant1 was deleted meanwhile and starts from the beginning."""
    jobs = b.index_of_old_orders(spark, folder, run_ts=MARK)
    jobs.delete("order", "tenant1")
    jobs.incremental("order", run_ts=MARK + 1)
    return order_status(jobs)


@suite.add(
    "selective_index",
    f"""{ORDERS_SQL}, CASE WHEN o_orderkey IN (SELECT user_id FROM events) THEN o_orderstatus ELSE 'OLD' END
              AS o_orderstatus
        FROM orders WHERE o_orderkey % 4 = 1 AND o_orderkey NOT IN (SELECT conv_id FROM conversations)
        UNION ALL {ORDERS_SQL}, 'OLD' FROM orders WHERE o_orderkey % 4 IN (0, 2)""",
)
def selective_index(spark, folder):
    """Ids of tenant1: those with events are indexed again, those with conversations deleted."""
    jobs = b.index_of_old_orders(spark, folder, run_ts=MARK)
    jobs.selective("tenant1", "order", b.table(spark, folder, "events").select("user_id"))
    gone = b.table(spark, folder, "conversations").select("conv_id")
    jobs.selective("tenant1", "order", gone, method="Delete")
    return order_status(jobs)


def latest_sql(text):
    return f"""(SELECT tenant, document_type, object_id, action FROM (
      SELECT tenant, document_type, object_id, action, row_number() OVER (
        PARTITION BY tenant, document_type, object_id ORDER BY event_time DESC, seq DESC) AS rn
      FROM {text} u WHERE action IN ('update', 'delete')) r WHERE rn = 1)"""


PLAIN_SQL = f"""(SELECT tenant_id AS tenant, object_code AS document_type, object_id, event_time, seq,
  CASE WHEN operation_type = 'DELETE' THEN 'delete' ELSE 'update' END AS action
  FROM ({b.for_sql(b.CHANGES)}) c)"""


@suite.add(
    "apply_changes",
    f"""SELECT o.tenant, o.doc_id, CASE WHEN l.action = 'update' THEN o.o_orderstatus ELSE 'OLD' END AS o_orderstatus
        FROM ({ORDERS_SQL}, o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 4 < 3) o
        LEFT JOIN (SELECT * FROM {latest_sql(PLAIN_SQL)} x WHERE document_type = 'order') l
          ON l.tenant = o.tenant AND l.object_id = o.o_orderkey
        WHERE l.action IS NULL OR l.action <> 'delete'""",
)
def apply_changes(spark, folder):
    """Updates are read again from the source, deletes leave a tombstone."""
    jobs = b.index_of_old_orders(spark, folder, run_ts=MARK)
    log = ch.classify(b.changes(spark, folder))
    items = stage(ch.latest_change(log.where("document_type = 'order'")), "items")
    jobs.apply_items(b.ORDER, items)
    return order_status(jobs)


@suite.add(
    "near_realtime_index",
    f"""SELECT o.tenant, o.document_type, o.doc_id,
               CASE WHEN o.document_type = 'customer' THEN NULL WHEN l.action = 'update' THEN o.status ELSE 'OLD' END
                 AS o_orderstatus
        FROM (SELECT 'tenant' || (o_orderkey % 4) AS tenant, 'order' AS document_type,
                     'tenant' || (o_orderkey % 4) || '_order_' || o_orderkey AS doc_id, o_orderkey AS id,
                     o_orderstatus AS status FROM orders
              UNION ALL SELECT 'tenant' || (c_custkey % 4), 'customer',
                     'tenant' || (c_custkey % 4) || '_customer_' || c_custkey, c_custkey, NULL FROM customer) o
        LEFT JOIN (SELECT * FROM {latest_sql(USABLE_SQL)} x WHERE NOT EXISTS (
                     SELECT 1 FROM {FLAGS_SQL} f WHERE f.tenant = x.tenant AND f.document_type = x.document_type
                       AND (f.bulk_update OR f.bulk_delete))) l
          ON l.tenant = o.tenant AND l.document_type = o.document_type AND l.object_id = o.id
        WHERE o.tenant IN ('tenant0', 'tenant1', 'tenant2') AND (l.action IS NULL OR l.action <> 'delete')
          AND NOT EXISTS (SELECT 1 FROM {FLAGS_SQL} f WHERE f.tenant = o.tenant AND f.deprovision)
          AND NOT EXISTS (SELECT 1 FROM {FLAGS_SQL} f WHERE f.tenant = o.tenant
                            AND f.document_type = o.document_type AND f.bulk_delete)""",
)
def near_realtime_index(spark, folder):
    """A log with item changes, bulk operations, a deprovision and rows nobody understands."""
    jobs = b.index_of_old_orders(spark, folder, run_ts=MARK)
    jobs.near_realtime(b.changes(spark, folder, b.BULK_CHANGES))
    orders = jobs.index.table("order").documents()
    customers = jobs.index.table("customer").documents()
    columns = ["tenant", "document_type", "doc_id"]
    return orders.select(*columns, "doc.o_orderstatus").unionByName(
        customers.select(*columns, F.lit(None).cast("string").alias("o_orderstatus"))
    )


@suite.add(
    "run_status",
    f"""SELECT t.tenant, d.document_type, CASE t.tenant WHEN 'tenant2' THEN 'Deleted' ELSE 'Completed' END AS status,
               CASE WHEN t.tenant = 'tenant0' AND d.document_type = 'order' THEN 'Incremental' ELSE 'Full' END
                 AS last_index_type,
               CAST(CASE WHEN t.tenant = 'tenant0' AND d.document_type = 'order' THEN {MARK} + 5 ELSE {MARK} END AS BIGINT)
                 AS last_indexed_at,
               'app' || substr(t.tenant, 7) AS appid
        FROM (SELECT DISTINCT 'tenant' || (o_orderkey % 4) AS tenant FROM orders WHERE o_orderkey % 4 < 3) t,
             (VALUES ('order'), ('customer')) d(document_type)""",
)
def run_status(spark, folder):
    """State after a full run, an incremental run of one tenant and a removed tenant."""
    jobs = b.indexer(spark, folder)
    jobs.full(run_ts=MARK)
    jobs.incremental("order", "tenant0", run_ts=MARK + 5)
    jobs.delete(None, "tenant2")
    return jobs.state.read().select(
        "tenant", "document_type", "status", "last_index_type", "last_indexed_at", "appid"
    )
