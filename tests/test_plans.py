"""Physical plans: what must reach the scan, stay in the JVM and not be shuffled."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from docloom.operators import changes as ch
from docloom.operators import search as se
from docloom.operators import store
from docloom.plans.documents import to_documents
from docloom.sources.tables import SharedTables, modified_since, query_rows, with_ids
from docloom.suite import base as b
from docloom.suite.base import CUSTOMER, ORDER
from docloom import workspace


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_modified_bound_and_columns_reach_the_scan(spark, data):
    b.register_tables(spark, data, "orders")
    rows = query_rows(spark, "SELECT o_orderkey, o_orderdate FROM orders")
    text = plan(modified_since(rows, "o_orderdate", 883_612_800).select("o_orderkey"))
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(o_orderdate", text)
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>", text)


def test_short_id_list_reaches_the_scan(spark, data):
    orders = b.table(spark, data, "orders")
    text = plan(with_ids(orders, "o_orderkey", [1, 2, 3]))
    assert re.search(r"PushedFilters: .*In\(o_orderkey", text)


def test_conversion_is_one_projection(spark, data):
    for index, name in ((ORDER, "orders"), (CUSTOMER, "customer")):
        documents = to_documents(b.rows_of(spark, data, index, name), index)
        text = plan(documents)
        assert "Exchange" not in text and "Python" not in text and "* Project" in text
        ids = plan(documents.select("doc_id"))
        assert "to_json" not in ids


def test_tenant_filter_reaches_the_scan_of_a_shared_table(spark, data):
    spark.sql("SELECT 'a' AS tenant, 1 AS id UNION ALL SELECT 'b', 2").createOrReplaceTempView("mixed")
    rows = SharedTables(spark).rows(b.IndexDef("x", {"s": "SELECT * FROM mixed"}), [b.Tenant("a")])
    assert rows.count() == 1


def test_latest_change_is_cut_before_the_shuffle(spark, data):
    text = plan(ch.latest_change(ch.classify(b.changes(spark, data))))
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


def test_search_does_not_shuffle(spark, data):
    documents = b.rows_of(spark, data, b.DOCUMENT, "documents")
    hits = se.search(documents, "the when", text=F.col("text"))
    assert "Exchange" not in plan(hits) and "Generate" not in plan(hits)
    assert "TakeOrderedAndProject" in plan(se.search_page(hits, 0, 10).select("doc_id"))


def test_store_reads_only_live_parts(spark, data, monkeypatch):
    monkeypatch.setattr(store, "NAMED_PARTS", 1)
    jobs = b.indexer(spark, data, b.IndexSet((ORDER,)))
    jobs.full(run_ts=1)
    b.table(spark, data, "orders").withColumn("o_orderstatus", F.lit("NEW")).createOrReplaceTempView("orders")
    jobs.full(run_ts=2)
    table = jobs.index.table("order")
    one = table.documents().where(F.col("tenant") == "tenant1").select("doc_id")
    text = plan(one)
    assert re.search(r"PartitionFilters: .*tenant1.*dynamicpruning", text)
    assert "source" not in re.search(r"ReadSchema: (.*doc_id.*)", text).group(1)
    one.collect()
    executed = one._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in executed
    live = {row.part for row in table.manifest().collect()}
    files = {f.split("/part=")[1].split("/")[0] for f in table.documents().inputFiles() if "/part=" in f}
    assert live < files
    monkeypatch.undo()
    assert "Join" not in plan(table.documents())
    files = {f.split("/part=")[1].split("/")[0] for f in table.documents().inputFiles()}
    assert live == files


def test_large_side_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(workspace, "BROADCAST_ROW_LIMIT", 5)
    small, large = spark.range(5), spark.range(6)
    hinted = [
        "broadcast" in workspace.broadcast_if_small(df)._jdf.queryExecution().logical().toString().lower()
        for df in (small, large)
    ]
    assert hinted == [True, False]


def test_merge_shuffles_rows_once(spark, data):
    """The placement of a commit also serves the per-id window and the writer."""
    jobs = b.indexer(spark, data, b.IndexSet((ORDER,)))
    table = jobs.index.table("order")
    documents = to_documents(jobs.source.rows(ORDER, jobs.tenants), ORDER)
    with workspace.Stage(spark) as stage:
        sized = table._plan(documents, table.manifest(), stage)
        text = plan(table._pick(table._arriving(documents), sized, "v"))
    assert text.count("hashpartitioning") == 1


def test_many_ids_in_clusters_reach_the_scan_as_intervals(spark, data):
    from docloom.sources import tables

    orders = b.table(spark, data, "orders")
    ids = [100_000 * cluster + n for cluster in range(20) for n in range(250)]
    text = plan(tables.with_ids(orders, "o_orderkey", ids))
    pushed = re.search(r"PushedFilters: (.*)", text).group(1)
    assert pushed.count("GreaterThanOrEqual(o_orderkey") == 20
    few = tables.intervals([(n, n + 1) for n in range(0, 9000, 7)] + [(10**12, 10**12), (-500, -500)], most=3)
    assert few == [(-500, -500), (0, 8996), (10**12, 10**12)]
    rows = spark.range(0, 10**7, 1000).toDF("o_orderkey")
    wanted = spark.range(0, 10**7, 777)
    found = {r.o_orderkey for r in tables.with_ids(rows, "o_orderkey", wanted).collect()}
    assert found == set(range(0, 10**7, 777000))


def test_files_of_pages_lie_in_folders_of_one_task_each(spark, root, monkeypatch):
    """So a commit moves, and a listing is dealt by, a bounded number of folders, not one for each page."""
    import base64
    import json

    from docloom.suite import scans

    monkeypatch.setattr(scans, "FILE_GROUPS", 4, raising=False)
    monkeypatch.setattr(scans, "fresh_path", lambda _spark, label: f"{root}/{label}")
    html = {n: f"<p>{n}</p>\n<i>" for n in range(40)} | {41: "", 42: "é"}
    spark.createDataFrame(list(html.items()), "page_id long, html string").write.parquet(f"{root}/pages.parquet")
    rows = scans.scan_binary_docs(spark, root).collect()
    assert {r.page_id: base64.b64decode(json.loads(r.source)["data"]).decode() for r in rows} == {n: x + "\n" for n, x in html.items()}
    assert len(rows) == len(html) and {r.tenant for r in rows} == {"tenant1"}
    assert 1 < len(workspace.child_names(spark, f"{root}/files/[!_]*")) <= 4
    files = workspace.child_names(spark, f"{root}/files/*/page_id=*/*.txt")
    tasks = {(x.split("/group=")[1].split("/")[0], re.search(r"/part-(\d+)", x).group(1)) for x in files}
    assert len(files) == len(html) and len(tasks) <= 4
