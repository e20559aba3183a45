"""The document store: create, upsert, delete, views and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.functions import keys
from docloom.model import IndexDef, IndexSet, Tenant
from docloom.plans.documents import to_documents
from docloom.plans.indexer import Indexer
from docloom.sources.tables import SharedTables
from docloom.suite import base as b
from docloom.workspace import fresh_path

suite = b.Suite()

ENABLED_SQL = "tenant IN ('tenant0', 'tenant1', 'tenant2')"
STATUS_SQL = "'tenant' || (o_orderkey % 4) || '_order_' || o_orderkey AS doc_id"


def new_order_table(spark):
    index = IndexDef("order", b.ORDER.queries, "o_orderkey", mapping={
        "o_orderkey": {"type": "long"}, "o_orderstatus": {"type": "keyword"}})
    return index, b.DocumentIndex(spark, IndexSet((index,)), fresh_path(spark, "store")).table("order")


def order_rows(spark, folder):
    return b.rows_of(spark, folder, b.ORDER, "orders")


@suite.add(
    "create_index",
    f"""SELECT tenant, document_type, count(*) AS documents FROM {b.ALL_DOCS_SQL} d WHERE {ENABLED_SQL}
        GROUP BY tenant, document_type""",
)
def create_index(spark, folder):
    """Created once, filled by a full run, counted from the manifest."""
    jobs = b.indexer(spark, folder)
    if jobs.index.create() != ["order", "customer"] or jobs.index.create() != []:
        raise AssertionError("tables are created exactly once")
    jobs.full(run_ts=1)
    parts = [
        jobs.index.table(kind).counts().select("tenant", F.lit(kind).alias("document_type"), "documents")
        for kind in ("order", "customer")
    ]
    return parts[0].unionByName(parts[1])


@suite.add(
    "put_mapping",
    """SELECT 'tenant' || (o_orderkey % 4) AS tenant, 'tenant' || (o_orderkey % 4) || '_order_' || o_orderkey AS doc_id,
              o_orderkey, o_orderstatus FROM orders""",
)
def put_mapping(spark, folder):
    """The first mapping of a type stays in force; a later definition reads the same columns."""
    index, table = new_order_table(spark)
    table.replace(to_documents(order_rows(spark, folder), index), order_rows(spark, folder))
    root = table.path.rsplit("/", 2)[0]
    later = IndexDef("order", index.queries, "o_orderkey", mapping={"o_custkey": {"type": "keyword"}})
    return b.DocumentIndex(spark, IndexSet((later,)), root).table("order").typed().drop("parent_key")


@suite.add(
    "drop_index",
    f"SELECT tenant, document_type, doc_id FROM {b.ALL_DOCS_SQL} d WHERE {ENABLED_SQL} AND document_type = 'order'",
)
def drop_index(spark, folder):
    """After the customer table is dropped, only orders are left."""
    jobs = b.indexer(spark, folder)
    jobs.full(run_ts=1)
    if not jobs.index.drop("customer"):
        raise AssertionError("the table is still there")
    return jobs.index.documents().select("tenant", "document_type", "doc_id")


@suite.add(
    "bulk_upsert",
    f"""SELECT {STATUS_SQL}, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus
        FROM orders WHERE o_orderstatus <> 'P' OR o_orderkey % 3 = 0""",
)
def bulk_upsert(spark, folder):
    """Two batches that overlap: same ids are replaced, new ones added."""
    rows = order_rows(spark, folder)
    index, table = new_order_table(spark)
    table.upsert(to_documents(rows.where("o_orderstatus <> 'P'"), index))
    changed = rows.where("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("X"))
    table.upsert(to_documents(changed, index))
    return table.typed().select("doc_id", "o_orderstatus")


@suite.add(
    "upsert_one",
    f"""SELECT {STATUS_SQL}, CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 'ONE'
               ELSE o_orderstatus END AS o_orderstatus FROM orders""",
)
def upsert_one(spark, folder):
    rows = order_rows(spark, folder)
    index, table = new_order_table(spark)
    table.upsert(to_documents(rows, index))
    newest = rows.agg(F.max("o_orderkey").alias("k")).first().k
    one = rows.where(F.col("o_orderkey") == newest).withColumn("o_orderstatus", F.lit("ONE"))
    table.upsert(to_documents(one, index))
    return table.typed().select("doc_id", "o_orderstatus")


@suite.add(
    "delete_by_tenant_type",
    f"""SELECT tenant, document_type, doc_id FROM {b.ALL_DOCS_SQL} d
        WHERE {ENABLED_SQL} AND NOT (tenant = 'tenant1' AND document_type = 'order')""",
)
def delete_by_tenant_type(spark, folder):
    jobs = b.indexer(spark, folder)
    jobs.full(run_ts=1)
    jobs.delete(" Order ,invoice", "tenant1")
    return jobs.index.documents().select("tenant", "document_type", "doc_id")


@suite.add(
    "delete_tenant",
    f"""SELECT tenant, document_type, doc_id FROM {b.ALL_DOCS_SQL} d WHERE tenant IN ('tenant0', 'tenant1')""",
)
def delete_tenant(spark, folder):
    jobs = b.indexer(spark, folder)
    jobs.full(run_ts=1)
    jobs.delete(None, "tenant2")
    return jobs.index.documents().select("tenant", "document_type", "doc_id")


@suite.add(
    "delete_by_ids",
    f"""SELECT {STATUS_SQL}, o_orderstatus FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')""",
)
def delete_by_ids(spark, folder):
    index, table = new_order_table(spark)
    table.upsert(to_documents(order_rows(spark, folder), index))
    lines = b.table(spark, folder, "lineitem").where("l_returnflag = 'A'")
    tenant = F.concat(F.lit("tenant"), F.col("l_orderkey") % 4)
    table.delete_ids(
        lines.select(
            tenant.alias("tenant"), keys.doc_id(tenant, "order", F.col("l_orderkey")).alias("doc_id")
        )
    )
    return table.typed().select("doc_id", "o_orderstatus")


@suite.add(
    "count_deleted",
    """SELECT 'tenant' || (o_orderkey % 4) AS tenant, count(*) AS deleted FROM orders
       WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A') GROUP BY 1""",
)
def count_deleted(spark, folder):
    """The difference of the manifests before and after; no document is read."""
    index, table = new_order_table(spark)
    table.upsert(to_documents(order_rows(spark, folder), index))
    before = table.counts().select("tenant", F.col("documents").alias("before"))
    tenant = F.concat(F.lit("tenant"), F.col("l_orderkey") % 4)
    lines = b.table(spark, folder, "lineitem").where("l_returnflag = 'A'")
    table.delete_ids(
        lines.select(
            tenant.alias("tenant"), keys.doc_id(tenant, "order", F.col("l_orderkey")).alias("doc_id")
        )
    )
    after = table.counts().select("tenant", F.col("documents").alias("after"))
    left = F.col("before") - F.coalesce("after", F.lit(0))
    return before.join(after, "tenant", "left").select("tenant", left.alias("deleted"))


@suite.add(
    "create_tenant_alias",
    f"""SELECT tenant, document_type, doc_id FROM {b.ALL_DOCS_SQL} d WHERE tenant = 'tenant1'""",
)
def create_tenant_alias(spark, folder):
    jobs = b.indexer(spark, folder)
    jobs.full(run_ts=1)
    if not jobs.index.alias_exists("tenant1"):
        raise AssertionError("the run makes a view per tenant")
    return spark.sql("SELECT tenant, document_type, doc_id FROM `tenant1`")


@suite.add(
    "create_plain_alias",
    f"SELECT document_type, count(*) AS documents FROM {b.ALL_DOCS_SQL} d WHERE {ENABLED_SQL} GROUP BY document_type",
)
def create_plain_alias(spark, folder):
    jobs = b.indexer(spark, folder)
    jobs.full(run_ts=1)
    jobs.index.create_alias("everything")
    return spark.sql("SELECT document_type, count(*) AS documents FROM everything GROUP BY document_type")


@suite.add(
    "drop_alias",
    f"""SELECT tenant, doc_id FROM {b.ALL_DOCS_SQL} d WHERE tenant IN ('tenant0', 'tenant2')""",
)
def drop_alias(spark, folder):
    """The views that are left after one is dropped."""
    jobs = b.indexer(spark, folder)
    jobs.full(run_ts=1)
    jobs.index.drop_alias("tenant1")
    left = [name for name in b.ENABLED if jobs.index.alias_exists(name)]
    return spark.sql(" UNION ALL ".join(f"SELECT tenant, doc_id FROM `{name}`" for name in left))


BAD_ROWS = """SELECT CASE WHEN o_orderkey % 100 = 7 THEN '' ELSE 'tenant' || (o_orderkey % 4) END AS tenant,
  CASE WHEN o_orderkey % 100 = 0 THEN NULL ELSE o_orderkey END AS o_orderkey, o_custkey, o_orderstatus FROM orders"""


@suite.add(
    "quarantine_bad_ids",
    """SELECT o_custkey, o_orderstatus, o_orderkey % 100 = 0 AS no_id, count(*) AS n FROM orders
       WHERE o_orderkey % 100 IN (0, 7) GROUP BY 1, 2, 3
       UNION ALL SELECT -1, 'kept', false, count(*) FROM orders WHERE o_orderkey % 100 NOT IN (0, 7)""",
)
def quarantine_bad_ids(spark, folder):
    """Rows without a tenant or id are kept aside, whole; the others are indexed."""
    b.register_tables(spark, folder, "orders")
    index, table = new_order_table(spark)
    table.upsert(to_documents(spark.sql(BAD_ROWS), index))
    bad = table.quarantined().select(
        F.from_json("source", "o_orderkey bigint, o_custkey bigint, o_orderstatus string").alias("j")
    )
    counted = bad.select(
        "j.o_custkey", "j.o_orderstatus", F.col("j.o_orderkey").isNull().alias("no_id")
    ).groupBy("o_custkey", "o_orderstatus", "no_id").agg(F.count(F.lit(1)).alias("n"))
    kept = table.documents().agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(-1).cast("bigint").alias("o_custkey"),
        F.lit("kept").alias("o_orderstatus"),
        F.lit(False).alias("no_id"),
        "n",
    )
    return counted.unionByName(kept)


@suite.add(
    "batch_report",
    """SELECT tenant, 'order' AS document_type, count(o_orderkey) AS records, CAST(500 AS BIGINT) AS batch_size,
              CAST(ceil(count(o_orderkey) / 500) AS BIGINT) AS total_batches, count(*) - count(o_orderkey) AS failures,
              TRUE AS timed
       FROM (SELECT 'tenant' || (o_orderkey % 4) AS tenant,
                    CASE WHEN o_orderkey % 100 <> 0 THEN o_orderkey END AS o_orderkey FROM orders) r
       GROUP BY tenant""",
)
def batch_report(spark, folder):
    """What a full run reports, with some ids missing in the source."""
    b.register_tables(spark, folder, "orders")
    query = """SELECT 'tenant' || (o_orderkey % 4) AS tenant,
                      CASE WHEN o_orderkey % 100 <> 0 THEN o_orderkey END AS o_orderkey FROM orders"""
    tenants = [Tenant(f"tenant{number}") for number in range(4)]
    index_set = IndexSet((IndexDef("order", {"spark": query}, "o_orderkey"),), batch_count=500)
    jobs = Indexer(spark, index_set, tenants, SharedTables(spark), fresh_path(spark, "index"))
    report = jobs.full(run_ts=1)[0].batch_table(spark)
    timed = (F.col("took_ms") > 0) & (F.col("ms_per_document") > 0)
    return report.withColumn("timed", timed).drop("took_ms", "ms_per_document")


@suite.add(
    "write_run_state",
    f"""SELECT tenant, appid, document_type, execution_started_at,
               CASE WHEN status = 'Running' THEN 2000000000 ELSE last_indexed_at END AS last_indexed_at,
               CASE WHEN status = 'Running' THEN 'Incremental' ELSE last_index_type END AS last_index_type,
               CASE WHEN status = 'Running' THEN 'Completed' ELSE status END AS status
        FROM ({b.for_sql(b.STATE)}) s""",
)
def write_run_state(spark, folder):
    """Running records are replaced by completed ones; the others stay."""
    records = b.states(spark, folder)
    state = b.store_state(spark, records)
    state.update(
        records.where("status = 'Running'")
        .withColumn("last_indexed_at", F.lit(2_000_000_000).cast("bigint"))
        .withColumn("last_index_type", F.lit("Incremental"))
        .withColumn("status", F.lit("Completed"))
    )
    return state.read()
