"""Filters, keys and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom import model
from docloom.functions import convert, keys, scalars
from docloom.model import dedupe_tenants
from docloom.operators import state as st
from docloom.sources import tables
from docloom.suite import base as b

suite = b.Suite()


@suite.add(
    "lowercase_columns",
    "SELECT c_custkey AS cust_key, c_name AS cust_name, c_acctbal AS balance FROM customer",
)
def lowercase_columns(spark, folder):
    customer = b.table(spark, folder, "customer")
    return convert.lowercase_columns(
        customer.select(
            F.col("c_custkey").alias("CUST_KEY"),
            F.col("c_name").alias("Cust_Name"),
            F.col("c_acctbal").alias("BALANCE"),
        )
    )


@suite.add("tag_tenant", "SELECT p_partkey, p_name, 'tenant7' AS tenant FROM part")
def tag_tenant(spark, folder):
    return tables.tag_tenant(b.table(spark, folder, "part").select("p_partkey", "p_name"), "tenant7")


@suite.add(
    "filter_modified_since",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'",
)
def filter_modified_since(spark, folder):
    b.register_tables(spark, folder, "orders")
    rows = tables.query_rows(spark, "SELECT o_orderkey, o_orderdate FROM orders WHERE 1 = 1")
    return tables.modified_since(rows, "o.o_orderdate", 883_612_800)


@suite.add(
    "filter_ids",
    """SELECT o_orderkey, o_orderstatus FROM orders
       WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
         AND o_orderkey IN (1, 3, 5, 7, 11, 101, 1001) OR o_orderkey IN (SELECT doc_id FROM documents)""",
)
def filter_ids(spark, folder):
    """A short list travels as a predicate, a table of ids as a semi join."""
    orders = b.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    lines = b.table(spark, folder, "lineitem").where("l_returnflag = 'R'").select("l_orderkey")
    listed = tables.with_ids(tables.with_ids(orders, "o_orderkey", lines), "o_orderkey", [1, 3, 5, 7, 11, 101, 1001])
    known = tables.with_ids(orders, "o_orderkey", b.table(spark, folder, "documents").select("doc_id"))
    return listed.union(known).distinct()


@suite.add(
    "filter_doc_types",
    f"SELECT doc_id, document_type FROM {b.ALL_DOCS_SQL} d WHERE lower(document_type) IN ('order', 'invoice')",
)
def filter_doc_types(spark, folder):
    documents = b.all_documents(spark, folder)
    return documents.where(
        scalars.in_type_list(F.col("document_type"), " ORDER , Invoice")
    ).select("doc_id", "document_type")


@suite.add(
    "filter_enabled_tenants",
    """SELECT o_orderkey, 'cust' || o_custkey AS tenant FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 5000)""",
)
def filter_enabled_tenants(spark, folder):
    orders = b.table(spark, folder, "orders").select(
        "o_orderkey", F.concat(F.lit("cust"), "o_custkey").alias("tenant")
    )
    return tables.filter_tenants(orders, b.customer_tenants(spark, folder)).select("o_orderkey", "tenant")


@suite.add(
    "filter_tenant_term",
    f"SELECT tenant, doc_id FROM {b.ALL_DOCS_SQL} d WHERE tenant = 'tenant3'",
)
def filter_tenant_term(spark, folder):
    return b.all_documents(spark, folder).where(F.col("tenant") == "tenant3").select("tenant", "doc_id")


@suite.add(
    "filter_running",
    f"""SELECT tenant, document_type, last_indexed_at FROM ({b.for_sql(b.STATE)}) s
        WHERE status = 'Running' AND document_type = 'order'""",
)
def filter_running(spark, folder):
    found = st.running(b.states(spark, folder), None, "order")
    return found.select("tenant", "document_type", "last_indexed_at")


@suite.add(
    "find_state",
    f"""SELECT tenant, document_type, status, last_indexed_at FROM ({b.for_sql(b.STATE)}) s
        WHERE document_type = 'customer'""",
)
def find_state(spark, folder):
    found = st.unique_state(st.find(b.states(spark, folder), None, "customer"))
    return found.select("tenant", "document_type", "status", "last_indexed_at")


@suite.add(
    "dedupe_tenants",
    """SELECT tenant, ordinal, app_id, kept FROM (
         SELECT 'tenant' || (c_custkey // 3) AS tenant, c_custkey AS ordinal, 'app' || c_nationkey AS app_id,
                row_number() OVER (PARTITION BY c_custkey // 3 ORDER BY c_custkey) = 1 AS kept
         FROM customer) t""",
)
def dedupe_tenants_query(spark, folder):
    definitions = b.table(spark, folder, "customer").selectExpr(
        "'tenant' || (c_custkey div 3) AS tenant", "c_custkey AS ordinal", "'app' || c_nationkey AS app_id"
    )
    first, repeated = dedupe_tenants(definitions)
    return first.withColumn("kept", F.lit(True)).unionByName(repeated.withColumn("kept", F.lit(False)))


@suite.add(
    "is_completed_type",
    f"""SELECT tenant, document_type FROM ({b.for_sql(b.STATE)}) s
        WHERE last_index_type IS NOT NULL AND lower(status) = 'completed'""",
)
def is_completed_type(spark, folder):
    return st.completed(b.states(spark, folder)).select("tenant", "document_type")


# -------------------------------------------------------------------- keys


@suite.add(
    "doc_id",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN
              'tenant' || (o_orderkey % 4) || '_order_' || o_orderkey END AS doc_id FROM orders""",
)
def doc_id(spark, folder):
    """An id that is no number gives no key."""
    rows = b.table(spark, folder, "orders").selectExpr(
        "o_orderkey",
        "'tenant' || (o_orderkey % 4) AS tenant",
        "CASE WHEN o_orderkey % 10 = 0 THEN 'none' ELSE cast(o_orderkey AS string) END AS key_text",
    )
    return rows.select(
        "o_orderkey", keys.doc_id(F.col("tenant"), "order", F.col("key_text")).alias("doc_id")
    )


@suite.add(
    "parent_key",
    """SELECT conv_id, turn, 'tenant' || (conv_id % 4) || '_project_' || conv_id AS parent_key
       FROM conversations""",
)
def parent_key(spark, folder):
    rows = b.table(spark, folder, "conversations")
    tenant = F.concat(F.lit("tenant"), F.col("conv_id") % 4)
    return rows.select(
        "conv_id", "turn", keys.parent_key(tenant, "project", F.col("conv_id")).alias("parent_key")
    )


@suite.add(
    "state_key",
    f"SELECT tenant || '_' || document_type AS state_key, status FROM ({b.for_sql(b.STATE)}) s",
)
def state_key(spark, folder):
    return b.states(spark, folder).select(
        keys.state_key(F.col("tenant"), F.col("document_type")).alias("state_key"), "status"
    )


# -------------------------------------------------------------------- scalar functions


@suite.add(
    "fn_lower",
    "SELECT p_partkey, lower(p_type) AS type_lower, lower(p_brand) AS brand_lower FROM part",
)
def fn_lower(spark, folder):
    return b.table(spark, folder, "part").select(
        "p_partkey", F.lower("p_type").alias("type_lower"), F.lower("p_brand").alias("brand_lower")
    )


@suite.add(
    "fn_equals_ignore_case",
    """SELECT c_custkey, lower(c_mktsegment) = lower('Machinery') AS is_machinery FROM customer""",
)
def fn_equals_ignore_case(spark, folder):
    same = scalars.equals_ignore_case(F.col("c_mktsegment"), F.lit("Machinery"))
    return b.table(spark, folder, "customer").select("c_custkey", same.alias("is_machinery"))


@suite.add(
    "fn_concat_key",
    "SELECT s_suppkey, 'tenant' || s_nationkey || '_supplier_' || s_suppkey AS key FROM supplier",
)
def fn_concat_key(spark, folder):
    tenant = F.concat(F.lit("tenant"), "s_nationkey")
    return b.table(spark, folder, "supplier").select(
        "s_suppkey", keys.doc_id(tenant, "supplier", F.col("s_suppkey")).alias("key")
    )


@suite.add(
    "fn_split_csv",
    """SELECT p_partkey, CAST(pos AS BIGINT) AS pos, trim(parts[pos]) AS part FROM (
         SELECT p_partkey, string_split(p_name || ' , ' || p_brand || ',' || p_type, ',') AS parts FROM part) q,
         (SELECT unnest([1, 2, 3]) AS pos) n""",
)
def fn_split_csv(spark, folder):
    text = F.concat_ws(",", F.concat("p_name", F.lit(" ")), F.concat(F.lit(" "), "p_brand"), "p_type")
    rows = b.table(spark, folder, "part").select("p_partkey", scalars.split_csv(text).alias("parts"))
    exploded = rows.select("p_partkey", F.posexplode("parts").alias("pos", "part"))
    return exploded.select("p_partkey", (F.col("pos") + 1).cast("bigint").alias("pos"), "part")


@suite.add(
    "fn_last_index",
    """SELECT page_id, CAST(CASE WHEN strpos(html, '>') = 0 THEN -1
              ELSE length(html) - strpos(reverse(html), '>') END AS BIGINT) AS last_at FROM pages""",
)
def fn_last_index(spark, folder):
    last = scalars.last_index_of(F.col("html"), ">").cast("bigint")
    return b.table(spark, folder, "pages").select("page_id", last.alias("last_at"))


@suite.add(
    "fn_try_long",
    """SELECT o_orderkey, try_cast(split_part(o_orderpriority, '-', 1) AS BIGINT) AS level,
              try_cast(o_orderpriority AS BIGINT) AS none FROM orders""",
)
def fn_try_long(spark, folder):
    return b.table(spark, folder, "orders").select(
        "o_orderkey",
        scalars.try_long(F.split_part("o_orderpriority", F.lit("-"), F.lit(1))).alias("level"),
        scalars.try_long(F.col("o_orderpriority")).alias("none"),
    )


@suite.add("fn_base64", "SELECT doc_id, to_base64(encode(text)) AS encoded FROM documents")
def fn_base64(spark, folder):
    return b.table(spark, folder, "documents").select("doc_id", scalars.base64_text(F.col("text")).alias("encoded"))


@suite.add(
    "fn_json_get",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
)
def fn_json_get(spark, folder):
    k = scalars.json_get(F.col("props"), "k", "bigint")
    return b.table(spark, folder, "events").select("event_id", k.alias("k"))


@suite.add(
    "fn_fingerprint",
    """SELECT doc_id, to_base64(unhex(sha1(text))) AS sha1_b64, to_base64(unhex(sha256(text))) AS sha256_b64,
              40 AS sha224_chars, 64 AS sha384_chars, 88 AS sha512_chars
       FROM documents""",
)
def fn_fingerprint(spark, folder):
    """All digests; those that the other engine lacks by their length, and in the tests by their values."""
    return b.table(spark, folder, "documents").select(
        "doc_id",
        scalars.fingerprint(F.col("text"), "SHA1").alias("sha1_b64"),
        scalars.fingerprint(F.col("text"), "SHA256").alias("sha256_b64"),
        *(F.length(scalars.fingerprint(F.col("text"), f"SHA{n}")).alias(f"sha{n}_chars") for n in (224, 384, 512)),
    )


@suite.add(
    "fn_is_blank",
    """SELECT event_id, CASE WHEN event_id % 3 = 2 THEN event_type ELSE 'row_id' END AS id_key FROM events""",
)
def fn_is_blank(spark, folder):
    given = F.when(F.col("event_id") % 3 == 0, None).when(F.col("event_id") % 3 == 1, "  ").otherwise(
        F.concat(F.lit(" "), "event_type")
    )
    key = scalars.blank_to_default(given, F.lit(model.DEFAULT_ID_KEY))
    return b.table(spark, folder, "events").select("event_id", key.alias("id_key"))
