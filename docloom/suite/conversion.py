"""Row to document conversion."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions import convert
from docloom.functions.mappers import custom_attributes, long_array, register_mapper
from docloom.operators.envelope import results_envelopes
from docloom.plans.documents import to_documents
from docloom.suite import base as b

suite = b.Suite()


def read_back(rows, json, schema):
    """Typed columns of a JSON text, so that engines compare values and not spellings."""
    return rows.select(F.from_json(json, schema).alias("j")).select("j.*")


@suite.add(
    "rows_to_json",
    """SELECT c_custkey, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":'
              || CASE WHEN c_nationkey = 0 THEN 'null' ELSE c_nationkey::VARCHAR END
              || ',"c_acctbal":' || c_acctbal || ',"c_mktsegment":"' || c_mktsegment || '"}' AS source FROM customer""",
)
def rows_to_json(spark, folder):
    customer = b.table(spark, folder, "customer").withColumn(
        "c_nationkey", F.nullif("c_nationkey", F.lit(0))
    )
    names = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    return customer.select("c_custkey", convert.row_json([F.col(n) for n in names]).alias("source"))


@suite.add(
    "json_numeric",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
              CAST(l_quantity AS DECIMAL(12, 2)) AS quantity_dec, l_partkey, l_suppkey,
              CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_tax END AS tax, CAST(l_linenumber AS SMALLINT) AS line_small
       FROM lineitem""",
)
def json_numeric(spark, folder):
    lines = b.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        F.col("l_quantity").cast("decimal(12,2)").alias("quantity_dec"), "l_partkey", "l_suppkey",
        F.when(F.col("l_returnflag") != "R", F.col("l_tax")).alias("tax"),
        F.col("l_linenumber").cast("smallint").alias("line_small"),
    )
    return read_back(lines, convert.row_json([F.col(n) for n in lines.columns]), lines.schema)


@suite.add(
    "json_boolean",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus = 'F' END AS finished,
              CASE WHEN o_orderstatus = 'P' THEN 'null' WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS written
       FROM orders""",
)
def json_boolean(spark, folder):
    orders = b.table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", (F.col("o_orderstatus") == "F").cast("int").cast("boolean")).alias("finished"),
    )
    source = convert.row_json([F.col("finished")])
    return orders.select(
        "o_orderkey",
        F.from_json(source, "finished boolean")["finished"].alias("finished"),
        F.regexp_extract(source, ":([a-z]+)", 1).alias("written"),
    )


@suite.add(
    "json_binary",
    "SELECT page_id, to_base64(encode(url)) AS url FROM pages",
)
def json_binary(spark, folder):
    pages = b.table(spark, folder, "pages").select("page_id", F.col("url").cast("binary").alias("url"))
    source = convert.row_json([F.col("page_id"), F.col("url")])
    return read_back(pages, source, "page_id bigint, url string")


@suite.add(
    "json_lob",
    """SELECT page_id, to_base64(encode(html)) AS content, html AS text FROM pages""",
)
def json_lob(spark, folder):
    """Large binaries as base64 and large texts as text, whole, in their own columns."""
    pages = b.table(spark, folder, "pages").select(
        "page_id", F.col("html").cast("binary").alias("content"), F.col("html").alias("text")
    )
    source = convert.row_json([F.col(n) for n in pages.columns])
    return read_back(pages, source, "page_id bigint, content string, text string")


@suite.add(
    "json_datetime",
    """SELECT l_orderkey, CAST(floor(epoch(l_shipdate)) AS BIGINT) AS shipped,
              strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.000') AS unmapped FROM lineitem""",
)
def json_datetime(spark, folder):
    lines = b.table(spark, folder, "lineitem").select(
        "l_orderkey", F.col("l_shipdate").alias("shipped"), F.col("l_shipdate").alias("unmapped")
    )
    mapped = convert.apply_epoch_fields(lines, {"shipped": {"type": "date", "format": "epoch_second"}})
    source = convert.row_json([F.col(n) for n in mapped.columns])
    return read_back(mapped, source, "l_orderkey bigint, shipped bigint, unmapped string")


@suite.add(
    "map_string_to_long_array",
    """SELECT o_orderkey, CAST(pos AS BIGINT) AS pos, vals[pos] AS value FROM (
         SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN [o_orderkey, o_custkey]
                  WHEN 1 THEN [o_orderkey] WHEN 2 THEN [1, NULL, o_custkey] ELSE [o_custkey, o_orderkey] END AS vals
         FROM orders) v, (SELECT unnest([1, 2, 3]) AS pos) n WHERE pos <= len(vals)""",
)
def map_string_to_long_array(spark, folder):
    text = """CASE o_orderkey % 4 WHEN 0 THEN o_orderkey || ',' || o_custkey WHEN 1 THEN '' || o_orderkey
              WHEN 2 THEN '1,x,' || o_custkey ELSE o_custkey || ', ' || o_orderkey || ',,' END AS ids"""
    rows = b.table(spark, folder, "orders").selectExpr("o_orderkey", text)
    mapped = rows.select("o_orderkey", F.posexplode(long_array(F.col("ids"))).alias("pos", "value"))
    return mapped.select("o_orderkey", (F.col("pos") + 1).cast("bigint").alias("pos"), "value")


@suite.add(
    "map_custom_attributes",
    """SELECT event_id, CAST(pos AS BIGINT) AS pos, attrs[pos].name AS name, attrs[pos].value AS value FROM (
         SELECT event_id, CASE event_id % 5
             WHEN 0 THEN [{'name': 'type', 'value': event_type}, {'name': 'user', 'value': user_id::VARCHAR}]
             WHEN 1 THEN [{'name': 'type', 'value': event_type}]
             WHEN 3 THEN [{'name': 'type', 'value': event_type}, {'name': 'user', 'value': user_id::VARCHAR}]
             END AS attrs FROM events) a, (SELECT unnest([1, 2]) AS pos) n WHERE pos <= len(attrs)""",
)
def map_custom_attributes(spark, folder):
    """Complete, cut in the second object, cut in the first, single-quoted, and null."""
    text = """CASE event_id % 5
      WHEN 0 THEN '[{"name":"type","value":"' || event_type || '"}, {"name":"user","value":"' || user_id || '"} ]'
      WHEN 1 THEN '[{"name":"type","value":"' || event_type || '"}, {"name":"us'
      WHEN 2 THEN '[{"name":"type","va'
      WHEN 3 THEN '[{''name'':''type'',''value'':''' || event_type || '''}, {''name'':''user'',''value'':''' || user_id || '''}]'
      END AS attributes"""
    rows = b.table(spark, folder, "events").selectExpr("event_id", text)
    mapped = rows.select(
        "event_id", F.posexplode(custom_attributes(F.col("attributes"))).alias("pos", "a")
    )
    return mapped.select("event_id", (F.col("pos") + 1).cast("bigint").alias("pos"), "a.name", "a.value")


@suite.add(
    "apply_mapping",
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(floor(epoch(o_orderdate)) AS BIGINT) AS o_orderdate,
              CAST(NULL AS VARCHAR) AS remark FROM orders""",
)
def apply_mapping(spark, folder):
    """Declared fields only, cast to their types; what the row lacks is a typed null."""
    mapping = {
        "o_orderkey": {"type": "long"},
        "o_custkey": {"type": "keyword"},
        "o_orderdate": {"type": "date", "format": "epoch_second"},
        "remark": {"type": "text"},
    }
    return convert.apply_mapping(b.table(spark, folder, "orders"), convert.document_schema(mapping))


def _initials(values: pd.Series) -> pd.Series:
    return values.str.split(" ").map(lambda words: "".join(word[:1] for word in words), na_action="ignore")


@suite.add(
    "custom_mapper",
    """SELECT p_partkey, upper(p_type) AS p_type,
              substr(p_name, 1, 1) || substr(split_part(p_name, ' ', 2), 1, 1) AS p_name, p_size FROM part""",
)
def custom_mapper(spark, folder):
    """One mapper of built-in functions, one in pandas; the number column is left alone."""
    register_mapper("upper", F.upper, T.StringType())
    register_mapper("initials", F.pandas_udf(_initials, "string"), "string")
    part = b.table(spark, folder, "part").select("p_partkey", "p_type", "p_name", "p_size")
    return convert.apply_mappers(part, {"P_TYPE": "upper", "P_Name": "initials", "p_size": "upper"})


@suite.add(
    "results_envelope",
    """SELECT tenant, batch_no, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
       FROM (SELECT *, (row_number() OVER (PARTITION BY tenant ORDER BY o_orderkey) - 1) // 100 AS batch_no
             FROM (SELECT *, 'tenant' || (o_orderkey % 4) AS tenant FROM orders) o) r""",
)
def results_envelope(spark, folder):
    """Envelopes of 100 rows of one tenant, opened again to compare all that they hold."""
    columns = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
    names = [column.split()[0] for column in columns.split(", ")]
    orders = b.table(spark, folder, "orders").select(
        F.concat(F.lit("tenant"), F.col("o_orderkey") % 4).alias("tenant"), *names
    )
    envelopes = results_envelopes(orders, "o_orderkey", 100, by=["tenant"])
    opened = F.from_json("envelope", f"results array<struct<{columns.replace(' ', ':').replace(',:', ',')}>>")
    return envelopes.select("tenant", "batch_no", F.inline(opened["results"]))
