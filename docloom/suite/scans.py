"""Scans, paging and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.convert import binary_document
from docloom.model import IndexDef
from docloom.operators import changes as ch
from docloom.operators import paging
from docloom.operators.search import stored_ids
from docloom.operators.store import DocumentTable
from docloom.plans.documents import to_documents
from docloom.sources.files import binary_documents, file_rows
from docloom.sources.tables import SharedTables, TenantTables, query_rows, tag_tenant, union_tenants
from docloom.streaming import file_changes, message_changes, run_change_stream
from docloom.suite import base as b
from docloom.workspace import fresh_path, is_directory

suite = b.Suite()

#: Folders that the files of pages are dealt to.
FILE_GROUPS = 512


@suite.add(
    "scan_index_query",
    "SELECT 'tenant' || (o_orderkey % 4) AS tenant, * FROM orders",
)
def scan_index_query(spark, folder):
    b.register_tables(spark, folder, "orders")
    index = IndexDef(
        "order",
        {
            "oracle": "SELECT 1 AS wrong_vendor",
            "MySQL": "SELECT 'tenant' || (o_orderkey % 4) AS tenant, * FROM orders;",
        },
    )
    return query_rows(spark, index.query_for("mysql"))


@suite.add(
    "scan_all_tenants",
    f"""SELECT tenant, document_type, doc_id FROM {b.ALL_DOCS_SQL} d
        WHERE tenant IN ('tenant0', 'tenant1', 'tenant2')""",
)
def scan_all_tenants(spark, folder):
    """Per-tenant tables: each tenant's text is analysed against its own views."""
    orders = b.table(spark, folder, "orders")
    customer = b.table(spark, folder, "customer")

    def tables(tenant):
        number = int(tenant.id[len("tenant"):])
        return {
            "orders": orders.where(F.col("o_orderkey") % 4 == number),
            "customer": customer.where(F.col("c_custkey") % 4 == number),
        }

    source = TenantTables(spark, tables)
    enabled = [tenant for tenant in b.FOUR_TENANTS[:4] if tenant.enabled]
    parts = []
    for index in (
        IndexDef("order", {"spark": "SELECT o_orderkey, o_custkey FROM orders"}, "o_orderkey"),
        IndexDef("customer", {"spark": "SELECT c_custkey, c_name FROM customer"}, "c_custkey"),
    ):
        documents = to_documents(source.rows(index, enabled), index)
        parts.append(
            documents.select("tenant", F.lit(index.document_type).alias("document_type"), "doc_id")
        )
    return union_tenants(parts)


@suite.add(
    "scan_one_tenant",
    """SELECT 'tenant1' AS tenant, 'tenant1_order_' || o_orderkey AS doc_id
       FROM orders WHERE o_orderkey % 4 = 1""",
)
def scan_one_tenant(spark, folder):
    b.register_tables(spark, folder, "orders")
    rows = SharedTables(spark).rows(b.ORDER, [b.FOUR_TENANTS[1]])
    return to_documents(rows, b.ORDER).select("tenant", "doc_id")


@suite.add(
    "page_by_modified",
    """SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders
       ORDER BY o_orderdate DESC, o_orderkey LIMIT 400 OFFSET 800""",
)
def page_by_modified(spark, folder):
    orders = b.table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    return paging.page_by_modified(orders, "o_orderdate", "o_orderkey", 800, 1200)


@suite.add(
    "page_by_rownum",
    """SELECT o_orderkey, o_orderdate, row_no FROM (
         SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_no
         FROM orders) r WHERE row_no >= 201 AND row_no < 1201""",
)
def page_by_rownum(spark, folder):
    orders = b.table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return paging.page_by_rownum(orders, "o_orderdate", "o_orderkey", 201, 1201)


@suite.add(
    "page_by_directory",
    """SELECT o_orderkey, o_orderdate, row_no FROM (
         SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS row_no
         FROM orders) r WHERE row_no > 900 AND row_no <= 1300""",
)
def page_by_directory(spark, folder):
    """A deep page from an order that is sorted once for all its pages."""
    orders = b.table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    directory = paging.PageDirectory(spark, fresh_path(spark, "pages"), range_rows=1000)
    return directory.build(orders, paging.newest_first("o_orderdate", "o_orderkey")).page(900, 1300)


@suite.add(
    "limit_offset",
    "SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 250 OFFSET 100",
)
def limit_offset(spark, folder):
    lines = b.table(spark, folder, "lineitem")
    order = [F.col(c).asc() for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    return paging.page(lines, order, 100, 350).select("l_orderkey", "l_linenumber")


@suite.add(
    "sort_modified_desc",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS row_no
       FROM orders""",
)
def sort_modified_desc(spark, folder):
    orders = b.table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    order = paging.newest_first("o_orderdate", "o_orderkey")
    return paging.global_row_number(orders, order).select("o_orderkey", "row_no")


@suite.add(
    "sort_change_log",
    f"""SELECT seq, row_number() OVER (ORDER BY object_id DESC, object_code, event_time, seq) AS row_no
        FROM ({b.for_sql(b.CHANGES)}) c""",
)
def sort_change_log(spark, folder):
    order = [*ch.log_order(), F.col("seq").asc()]
    return paging.global_row_number(b.changes(spark, folder), order).select("seq", "row_no")


@suite.add(
    "scan_change_log",
    f"SELECT * FROM ({b.for_sql(b.CHANGES)}) c WHERE tenant_id = 'tenant1'",
)
def scan_change_log(spark, folder):
    return ch.change_log(b.changes(spark, folder), "tenant1")


@suite.add(
    "stream_changes_kafka",
    f"""SELECT tenant_id AS tenant, object_code AS document_type,
               CASE WHEN operation_type = 'DELETE' THEN 'delete' ELSE 'update' END AS action,
               object_id, event_time, seq
        FROM ({b.for_sql(b.CHANGES)}) c""",
)
def stream_changes_kafka(spark, folder):
    """The message path of a topic, fed from the event files: parse, classify, land."""
    events = f"{folder}/events.parquet"
    schema = spark.read.parquet(events).schema
    if is_directory(spark, events):
        stream = file_changes(spark, events, schema)
    else:
        stream = file_changes(spark, folder, schema, "events.parquet")
    stream.createOrReplaceTempView("event_stream")
    messages = spark.sql(b.for_spark(b.CHANGES).replace("FROM events", "FROM event_stream"))
    body = F.to_json(F.struct("tenant_id", "object_code", "operation_type", "object_id"))
    parsed = message_changes(
        messages.select(body.alias("value"), "event_time", "seq"),
        "value",
        F.timestamp_seconds("event_time"),
        F.col("seq"),
    )
    landed = fresh_path(spark, "landed")

    def land(batch):
        usable, _ = ch.split_problems(ch.classify(batch))
        chosen = usable.select("tenant", "document_type", "action", "object_id", "event_time", "seq")
        chosen.write.mode("append").parquet(landed)

    run_change_stream(parsed, land, fresh_path(spark, "offsets")).awaitTermination()
    return spark.read.parquet(landed)


@suite.add("scan_run_state", b.for_sql(b.STATE))
def scan_run_state(spark, folder):
    return b.store_state(spark, b.states(spark, folder)).read()


@suite.add(
    "scan_documents",
    f"""SELECT doc_id FROM {b.ALL_DOCS_SQL} d
        WHERE tenant = 'tenant2' AND document_type IN ('order', 'customer')""",
)
def scan_documents(spark, folder):
    return stored_ids(b.all_documents(spark, folder), ["order", "customer"], "tenant2")


@suite.add(
    "binary_to_base64_doc",
    """SELECT page_id, '{"data":"' || to_base64(encode(html)) || '"}' AS source FROM pages""",
)
def binary_to_base64_doc(spark, folder):
    pages = b.table(spark, folder, "pages")
    return pages.select("page_id", binary_document(F.col("html").cast("binary")).alias("source"))


def page_files(pages, path):
    """A file for each page, below folders that one task each writes.

    So the commit moves these folders, not a folder for each page, one after the other on the driver, and
    they are listed side by side in as many tasks.
    """
    group = F.pmod(F.hash("page_id"), F.lit(FILE_GROUPS))
    rows = pages.select(group.alias("group"), "page_id", F.col("html").alias("value"))
    dealt = rows.repartition(FILE_GROUPS, "group")
    dealt.write.partitionBy("group", "page_id").option("maxRecordsPerFile", 1).text(path)
    return path


@suite.add(
    "scan_binary_docs",
    """SELECT page_id, 'tenant1' AS tenant, '{"data":"' || to_base64(encode(html || chr(10))) || '"}' AS source
       FROM pages""",
)
def scan_binary_docs(spark, folder):
    """Each page's html as a file of its own, read as binary, indexed for a tenant and read back."""
    files = page_files(b.table(spark, folder, "pages"), fresh_path(spark, "files"))
    fields = T.StructType([T.StructField("path", T.StringType())])
    table = DocumentTable(spark, fresh_path(spark, "binary"), "file", fields)
    table.upsert(file_rows(binary_documents(spark, files, "*.txt"), "tenant1", "file"))
    page = F.regexp_extract("doc.path", r"page_id=(\d+)/", 1).cast("bigint")
    return table.documents().select(page.alias("page_id"), "tenant", "source")


@suite.add(
    "union_tenants",
    """SELECT 'tenant' || (o_orderkey % 4) AS tenant, o_orderkey,
              CASE WHEN o_orderkey % 4 <> 2 THEN o_orderstatus END AS o_orderstatus
       FROM orders WHERE o_orderkey % 4 < 3""",
)
def union_tenants_query(spark, folder):
    orders = b.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    parts = [
        tag_tenant(orders.where(F.col("o_orderkey") % 4 == number), f"tenant{number}")
        for number in (0, 1, 2)
    ]
    parts[2] = parts[2].drop("o_orderstatus")
    return union_tenants(parts)


SETOP = """
(SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
UNION ALL
(SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT p_partkey FROM part WHERE p_size > 25)"""


@suite.add("index_query_setop", SETOP)
def index_query_setop(spark, folder):
    b.register_tables(spark, folder, "customer", "orders", "lineitem", "part")
    return query_rows(spark, SETOP)


@suite.add(
    "fn_epoch_now",
    """SELECT o_orderkey, CAST(1700000000 AS BIGINT) AS run_ts,
              1700000000 - CAST(floor(epoch(o_orderdate)) AS BIGINT) AS age_seconds FROM orders""",
)
def fn_epoch_now(spark, folder):
    """One literal per run, so every row of a run carries the same time."""
    clock = 1_700_000_000
    orders = b.table(spark, folder, "orders")
    return orders.select(
        "o_orderkey",
        F.lit(clock).cast("bigint").alias("run_ts"),
        (F.lit(clock) - F.unix_seconds(F.col("o_orderdate").cast("timestamp"))).alias("age_seconds"),
    )
