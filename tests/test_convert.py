"""Keys, mappers, mapping, changes and search on small inputs."""

import pytest
from pyspark.sql import functions as F

from docloom import model
from docloom.functions import convert, keys, mappers, scalars
from docloom.model import IndexDef, IndexSet, ParentLink, clamp_batch_count, read_mapping
from docloom.operators import changes as ch
from docloom.operators import search as se
from docloom.operators import state as st
from docloom.operators.envelope import results_envelopes
from docloom.operators.paging import global_row_number, page
from docloom.plans.documents import to_documents
from docloom.sources.tables import modified_since, query_rows
from docloom.workspace import local_frame


def values(df, column):
    return df.select(column).toPandas().iloc[:, 0].tolist()


def mapped(spark, function, texts):
    rows = local_frame(spark, [(n, t) for n, t in enumerate(texts)], "n int, v string")
    return [r.m for r in rows.select("n", function(F.col("v")).alias("m")).orderBy("n").collect()]


def test_long_array(spark):
    texts = ["1,2,3", "7", "1,x,3", "1,2,", " 4 , 5", "", None, "9223372036854775808,1"]
    want = [[1, 2, 3], [7], [1, None, 3], [1, 2], [4, 5], [None], None, [None, 1]]
    assert mapped(spark, mappers.long_array, texts) == want


def test_custom_attributes(spark):
    texts = [
        '[{"name":"a","value":"b"} ]',
        '[{"name":"a","value":"b"}, {"name":"c","va',
        '[{"name":"a","va',
        "[{'name':'a','value':'b'}]",
        None,
        "nonsense",
        "",
    ]
    got = mapped(spark, mappers.custom_attributes, texts)
    pairs = [None if v is None else [(a.name, a.value) for a in v] for v in got]
    assert pairs == [[("a", "b")], [("a", "b")], [], [("a", "b")], None, [], []]


def test_last_index_of(spark):
    assert mapped(spark, lambda c: scalars.last_index_of(c, "}"), ["a}b}", "}", "ab", ""]) == [3, 0, -1, -1]


def test_doc_id_needs_tenant_and_number(spark):
    rows = local_frame(
        spark,
        [("t", "5"), ("t", "x"), ("t", None), ("", "5"), (None, "5"), ("t", "5000000000")],
        "tenant string, id string",
    )
    got = values(rows, keys.doc_id(F.col("tenant"), "k", F.col("id")))
    assert got == ["t_k_5", None, None, None, None, "t_k_5000000000"]


def test_find_column(spark):
    df = local_frame(spark, [], "Student_ID int, name string")
    assert keys.find_column(df, "student_id") == "Student_ID"
    assert keys.find_column(df, "s.STUDENT_ID") == "Student_ID"
    assert keys.find_column(df, "other") is None


def test_lowercase_collision(spark):
    with pytest.raises(ValueError, match="collide"):
        convert.lowercase_columns(spark.sql("SELECT 1 AS a, 2 AS A"))


def test_documents_of_a_mapped_query(spark):
    rows = spark.sql(
        "SELECT 't' AS tenant, 1 AS Row_Id, 9 AS resource_id, TIMESTAMP '2024-01-02 03:04:05' AS made, "
        "TIMESTAMP '2024-01-02 03:04:05' AS seen, '1,2' AS refs, X'00FF' AS blob, CAST(NULL AS string) AS gone"
    )
    index = IndexDef(
        "conversation", {"spark": ""}, mapping={
            "made": {"type": "date", "format": "epoch_second"}, "refs": {"type": "long"}, "missing": {"type": "long"}},
        mappers={"REFS": "long_array"}, parent=ParentLink("project", "resource_id"),
    )
    document = to_documents(rows, index).first()
    assert (document.doc_id, document.parent_key) == ("t_conversation_1", "t_project_9")
    assert document.source == (
        '{"tenant":"t","row_id":1,"resource_id":9,"made":1704164645,"seen":"2024-01-02T03:04:05.000Z",'
        '"refs":[1,2],"blob":"AP8=","gone":null}'
    )
    assert document.doc.asDict() == {"made": 1704164645, "refs": [1, 2], "missing": None}


def test_nested_columns_stay_nested(spark):
    rows = spark.sql("SELECT 't' AS tenant, 1 AS row_id, array(1, 2) AS a, named_struct('x', 'y') AS s")
    document = to_documents(rows, IndexDef("d", {"spark": ""})).first()
    assert document.doc.asDict() == {"tenant": "t"}
    assert document.source == '{"tenant":"t","row_id":1,"a":[1,2],"s":{"x":"y"}}'


def test_configuration_defaults():
    index = IndexDef("d", {"MySQL": "my", "oracle": "ora"}, id_key="  ")
    assert (index.id_column, index.modified_column) == (model.DEFAULT_ID_KEY, model.DEFAULT_MODIFIED_KEY)
    assert [index.query_for(v) for v in ("ORACLE", "mysql", "mssql", None)] == ["ora", "my", "my", "my"]
    assert [clamp_batch_count(n) for n in (0, 1, 500_000, 500_001)] == [10_000, 1, 500_000, 10_000]
    chosen = IndexSet((index, IndexDef("Other", {"x": ""}))).select(" other ,nothing")
    assert [i.document_type for i in chosen] == ["Other"]


def test_combined_mapping():
    text = '{"a": {"dynamic": "false", "properties": {"x": {"type": "long"}}}, "b": {"properties": {}}}'
    assert read_mapping(text) == {"a": {"x": {"type": "long"}}, "b": {}}
    with pytest.raises(ValueError, match="unknown mapping type"):
        convert.document_schema({"x": {"type": "shape"}})


def test_wrapped_query_takes_any_select(spark):
    rows = query_rows(spark, "SELECT id % 3 AS k, max(id) AS m FROM range(10) GROUP BY 1 ;")
    assert sorted(values(modified_since(rows, "q.m", 8), "m")) == [8, 9]


def test_pages_unite_to_the_whole(spark):
    rows = spark.range(0, 1000).select("id", (F.col("id") % 7).alias("mod"))
    order = [F.col("mod").desc(), F.col("id").asc()]
    numbered = global_row_number(rows, order)
    want = sorted(range(1000), key=lambda n: (-(n % 7), n))
    assert [r.id for r in numbered.orderBy("row_no").collect()] == want
    assert sorted(values(numbered, "row_no")) == list(range(1, 1001))
    pages = [values(page(rows, order, start, start + 300), "id") for start in range(0, 1000, 300)]
    assert [n for one in pages for n in one] == want


def test_pages_of_a_directory(spark, root):
    """All pages unite to the whole; a page reads no range but its own; builds of others do not move it."""
    from docloom import workspace
    from docloom.operators.paging import PageDirectory

    rows = spark.range(0, 1000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("mod"))
    order = [F.col("mod").desc_nulls_last(), F.col("id").asc()]
    want = sorted(range(1000), key=lambda n: (n % 3 == 0, -(n % 7) if n % 3 else 0, n))
    directory = PageDirectory(spark, root, range_rows=100)
    with pytest.raises(ValueError, match="no directory"):
        directory.page(0, 1)
    directory.build(rows, order, "one")
    found = []
    for start in range(0, 1100, 300):
        one = directory.page(start, start + 300).collect()
        assert [r.row_no for r in one] == list(range(start + 1, min(start + 300, 1000) + 1))
        found += [r.id for r in one]
    assert found == want
    assert directory.page(5, 5).collect() == [] and directory.page(0, 1).columns == ["id", "mod", "row_no"]
    with pytest.raises(ValueError, match="bad page"):
        directory.page(3, 2)
    # without the folders of all other ranges the page is still there
    starts = directory.snapshots.read().orderBy("range").collect()
    held = {r.range for r in starts if r.before < 620 and r.before + r.rows > 610}
    assert len(starts) > 5 and len(held) <= 2
    for r in starts:
        if r.range not in held:
            workspace.delete_path(spark, f"{r.folder}/_range={r.range}")
    assert [r.id for r in directory.page(610, 620).collect()] == want[610:620]
    other = PageDirectory(spark, root, range_rows=100).build(rows.limit(0), order, "two")
    assert other.page(0, 10).collect() == [] and other.mark == "two"
    assert directory.mark == "one" and [r.id for r in directory.page(610, 620).collect()] == want[610:620]
    assert other.vacuum() == 0 and other.vacuum(older_than=-1) == 1


def test_ranges_of_a_directory_do_not_multiply_with_its_rows(spark, root, monkeypatch):
    """Beyond the most ranges they grow to the largest size, and only then in number; pages are the same."""
    from docloom.operators import paging

    monkeypatch.setattr(paging, "MOST_RANGES", 4)
    monkeypatch.setattr(paging, "RANGE_ROWS", 100)
    order = [F.col("id").desc()]
    for rows, most in ((400, 4), (1000, 10)):
        directory = paging.PageDirectory(spark, f"{root}/{rows}", range_rows=10).build(spark.range(rows), order)
        starts = directory.snapshots.read().orderBy("range").collect()
        assert 2 <= len(starts) <= most and sum(r.rows for r in starts) == rows
        found = [(r.id, r.row_no) for r in directory.page(85, 325).collect()]
        assert found == [(rows - n, n) for n in range(86, 326)]


def test_deep_page_uses_the_ranged_rank(spark, monkeypatch):
    from docloom.operators import paging

    monkeypatch.setattr(paging, "SHALLOW_ROWS", 10)
    rows = spark.range(0, 500)
    assert sorted(values(page(rows, [F.col("id").desc()], 100, 110), "id")) == list(range(390, 400))


def test_envelopes_are_bounded_and_whole(spark):
    rows = spark.range(0, 25).select("id", F.when(F.col("id") != 3, F.lit("x")).alias("v"))
    got = results_envelopes(rows, "id", 10).orderBy("batch_no").collect()
    assert [r.records for r in got] == [10, 10, 5]
    assert got[0].envelope.startswith('{"results":[{"id":0,"v":"x"},') and '{"id":3,"v":null}' in got[0].envelope


OPERATIONS = [
    ("CREATE", "update"), ("Update", "update"), ("ACCESS_CHANGED_INSTANCE", "update"),
    ("access_changed_obs", "update"), ("ACCESS_CHANGED_GROUP", "update"), ("Delete", "delete"),
    ("BulkUpdate", "bulk_update"), ("BULKDELETE", "bulk_delete"), ("SliceDeprovisioned", "deprovision"),
    ("SLICE_DEPROVISION", "deprovision"), ("PAINT", None),
]


@pytest.mark.parametrize("text,action", OPERATIONS)
def test_operation_names(spark, text, action):
    assert values(local_frame(spark, [(text,)], "op string"), ch.action_of(F.col("op"))) == [action]


def test_latest_change_breaks_ties(spark):
    rows = [
        ("t", "k", "UPDATE", 1, 5, None), ("t", "k", "DELETE", 1, 5, None),
        ("t", "k", "DELETE", 2, 5, 1), ("t", "k", "UPDATE", 2, 5, 2),
        ("t", "k", "DELETE", 3, 4, 9), ("t", "k", "UPDATE", 3, 5, 1),
        ("t", "other", "DELETE", 1, 9, None),
    ]
    latest = ch.latest_change(ch.classify(local_frame(spark, rows, ch.CHANGE_SCHEMA)))
    got = {(r.document_type, r.object_id): r.operation_type for r in latest.collect()}
    assert got == {("k", 1): "DELETE", ("k", 2): "UPDATE", ("k", 3): "UPDATE", ("other", 1): "DELETE"}


def test_bad_messages_are_set_aside(spark):
    texts = ['{"tenant_id":"t","object_code":"k","operation_type":"DELETE","object_id":7}',
             '{"tenant_id":"t","object_code":"k","operation_type":"DELETE","object_id":"8"}',
             "garbage", '{"tenant_id":"t","object_code":"k","operation_type":"DELETE"}',
             '{"tenant_id":"t","object_code":"k","operation_type":"SING","object_id":1}']
    messages = local_frame(spark, [(t, 1, n) for n, t in enumerate(texts)], "value string, event_time bigint, seq bigint")
    good, bad = ch.split_problems(ch.classify(ch.parse_messages(messages)))
    assert sorted(values(good, "object_id")) == [7, 8]
    assert {r.seq: r.problem for r in bad.collect()} == {2: "incomplete", 3: "no object id", 4: "unknown operation"}
    assert values(bad.where("seq = 2"), "message") == ["garbage"]


def test_last_run_and_inventory(spark):
    schema = "tenant string, document_type string, status string, last_indexed_at bigint"
    state = local_frame(spark, [("a", "x", "Completed", 5), ("a", "y", "Deleted", 6), ("b", "x", "Not Run", 7)], schema)
    pairs = local_frame(spark, [(t, k) for t in "ab" for k in "xy"], "tenant string, document_type string")
    got = {(r.tenant, r.document_type): r.last_run for r in st.last_run(pairs, state).collect()}
    assert got == {("a", "x"): 5, ("a", "y"): 0, ("b", "x"): 7, ("b", "y"): 0}
    tenants = local_frame(spark, [("a", True), ("b", False)], "tenant string, enabled boolean")
    state = state.withColumn("appid", F.lit(None))
    listed = st.status_inventory(tenants, ["x", "y"], state)
    assert {(r.tenant, r.document_type): r.status for r in listed.collect()} == {
        ("a", "x"): "Completed", ("a", "y"): "Deleted", ("b", "x"): "Not Run", ("b", "y"): "Not Run"}
    assert st.status_inventory(tenants, ["x", "y"], state, enabled="false", status="NOT RUN").count() == 2
    assert st.status_inventory(tenants, ["x", "y"], state, tenant="a", status="all").count() == 2


def test_search_against_brute_force(spark):
    texts = ["the cat, the dog", "A CAT!", "dogma", "", "cat dog cat", "nothing here"]
    rows = local_frame(spark, [(n, t) for n, t in enumerate(texts)], "doc_id int, text string")
    hits = se.search(rows, "Cat  dog", text=F.col("text"))
    got = [(r.doc_id, r.matched_terms, r.total_matches) for r in se.search_page(hits, 0, 10).collect()]
    assert got == [(4, 2, 3), (0, 2, 2), (1, 1, 1)]
    assert [r.doc_id for r in se.search_page(hits, 1, 1).collect()] == [0]
    assert se.search(rows, " ;", text=F.col("text")).count() == 0


def test_fingerprints_equal_the_standard_librarys(spark):
    import base64
    import hashlib

    from docloom.functions import scalars

    texts = ["", "abc", "é漢😀" * 100]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for name in scalars.DIGESTS:
        found = [r[0] for r in df.select(scalars.fingerprint(df.t, name)).collect()]
        assert found == [base64.b64encode(hashlib.new(name.lower(), t.encode()).digest()).decode() for t in texts]


def test_no_envelope_is_larger_than_the_bound(spark):
    """Wide rows cut a batch into pieces, in order; a row that is larger by itself stands alone."""
    import json

    from docloom.operators.envelope import results_envelopes

    rows = [("t", n, "x" * (n * 37 % 900)) for n in range(300)] + [("t", 300, "y" * 5000), ("t", 301, "z"), ("u", 1, None)]
    df = spark.createDataFrame(rows, "tenant string, id bigint, text string")
    found = results_envelopes(df, "id", 100, by=["tenant"], max_bytes=2000).orderBy("tenant", "batch_no", "piece").collect()
    seen, sizes = [], {}
    for one in found:
        results = json.loads(one.envelope)["results"]
        assert one.records == len(results)
        assert len(one.envelope) - len('{"results":[]}') - len(results) + 1 <= 2000 or len(results) == 1
        seen += [(one.tenant, r["id"]) for r in results]
        sizes[one.tenant, one.batch_no] = sizes.get((one.tenant, one.batch_no), 0) + len(results)
    assert seen == [(r[0], r[1]) for r in rows]
    assert sizes == {("t", 0): 100, ("t", 1): 100, ("t", 2): 100, ("t", 3): 2, ("u", 0): 1}
    assert len(found) > 40
    whole = results_envelopes(df, "id", 100, by=["tenant"])
    assert {(r.tenant, r.batch_no, r.piece, r.records) for r in whole.collect()} == {
        (tenant, batch, 0, n) for (tenant, batch), n in sizes.items()}


def test_rare_words_and_short_texts_rank_first(spark):
    import math

    rows = [(n, "common word " * (1 + n % 3) + ("rare" if n in (7, 11) else "")) for n in range(30)] + [(40, ""), (41, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.score for r in se.ranked(df, "common RARE absent", text=F.col("text")).collect()}
    cut = {n: (t or "").split() for n, t in rows}
    mean = sum(map(len, cut.values())) / len(cut)
    for n, words in cut.items():
        score = 0.0
        for term in ("common", "rare", "absent"):
            held = sum(term in w for w in cut.values())
            tf = words.count(term)
            score += math.log(1 + (len(cut) - held + 0.5) / (held + 0.5)) * 2.2 * tf / (tf + 1.2 * (0.25 + 0.75 * len(words) / mean))
        assert (n in found) == (score > 0)
        assert n not in found or abs(found[n] - score) < 2e-6
    page = [r.doc_id for r in se.search_page(se.ranked(df, "common rare", text=F.col("text")), 0, 2).collect()]
    assert set(page) == {7, 11}
    assert se.ranked(df, ";", text=F.col("text")).collect() == []
