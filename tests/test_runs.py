"""Run modes: equivalences, state, failures, streaming and sources."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from docloom import IndexDef, Indexer, IndexSet, Tenant
from docloom.operators import changes as ch
from docloom.sources import SharedTables, TenantTables, binary_documents, jdbc_options
from docloom.streaming import file_changes, message_changes, run_change_stream
from docloom.workspace import fresh_path, local_frame

ITEM = IndexDef(
    "item",
    {"spark": "SELECT tenant, id, v, changed FROM items"},
    "id",
    "changed",
    mapping={"id": {"type": "long"}, "v": {"type": "keyword"}},
)
NOTE = IndexDef("note", {"spark": "SELECT tenant, id FROM notes"}, "id")
TENANTS = (Tenant("a", "appa"), Tenant("b", "appb"), Tenant("off", enabled=False), Tenant("a", "again"))


def put_items(spark, rows):
    local_frame(spark, rows, "tenant string, id bigint, v string, changed bigint").createOrReplaceTempView("items")


def put_notes(spark, rows):
    local_frame(spark, rows, "tenant string, id bigint").createOrReplaceTempView("notes")


def new_indexer(spark, root, *indexes):
    return Indexer(spark, IndexSet(indexes or (ITEM,)), TENANTS, SharedTables(spark), root)


def content(jobs, kind="item"):
    return {r.doc_id: r.doc.v for r in jobs.index.table(kind).documents().select("doc_id", "doc").collect()}


def state_of(jobs):
    return {(r.tenant, r.document_type): r for r in jobs.state.read().collect()}


def test_full_run(spark, root):
    put_items(spark, [("a", 1, "x", 10), ("b", 2, "y", 20), ("off", 3, "z", 30), ("stranger", 4, "w", 1)])
    put_notes(spark, [("a", 1), ("a", None)])
    jobs = new_indexer(spark, root, ITEM, NOTE)
    assert [t.app_id for t in jobs.duplicate_tenants] == ["again"]
    reports = jobs.full(run_ts=100)
    assert [(r.document_type, r.status, r.rows_in, r.rows_quarantined) for r in reports] == [
        ("item", "Completed", 2, 0), ("note", "Completed", 2, 1)]
    assert content(jobs) == {"a_item_1": "x", "b_item_2": "y"}
    seen = spark.sql("SELECT doc_id FROM a ORDER BY 1").collect()
    assert [r.doc_id for r in seen] == ["a_item_1", "a_note_1"]
    record = state_of(jobs)[("a", "item")]
    assert (record.status, record.last_indexed_at, record.last_index_type, record.appid) == (
        "Completed", 100, "Full", "appa")
    put_items(spark, [("a", 5, "n", 10)])
    jobs.full("item", run_ts=200)
    assert content(jobs) == {"a_item_5": "n"}
    put_items(spark, [("b", 6, "n", 10)])
    jobs.full("item", tenant="b", run_ts=300)
    assert content(jobs) == {"a_item_5": "n", "b_item_6": "n"}


def test_incremental_from_nothing_equals_full(spark, root):
    put_items(spark, [("a", n, f"v{n}", n) for n in range(50)] + [("b", 1, "q", None)])
    first, second = new_indexer(spark, root + "1"), new_indexer(spark, root + "2")
    first.full(run_ts=1)
    second.incremental(run_ts=1)
    assert content(first) == content(second) and len(content(first)) == 51


def test_incremental_bound_is_inclusive_and_per_tenant(spark, root):
    put_items(spark, [("a", 1, "x", 10), ("b", 1, "x", 10)])
    jobs = new_indexer(spark, root)
    jobs.full(tenant="a", run_ts=100)
    jobs.full(tenant="b", run_ts=50)
    put_items(spark, [(t, n, "new", at) for t in "ab" for n, at in ((2, 49), (3, 50), (4, 99), (5, 100))])
    report = jobs.incremental(run_ts=200)[0]
    assert report.rows_in == 4
    assert set(content(jobs)) == {"a_item_1", "a_item_5", "b_item_1", "b_item_3", "b_item_4", "b_item_5"}
    assert {r.last_indexed_at for r in state_of(jobs).values()} == {200}


def test_rows_that_vanish_stay_until_a_full_run(spark, root):
    put_items(spark, [("a", 1, "x", 10), ("a", 2, "y", 10)])
    jobs = new_indexer(spark, root)
    jobs.full(run_ts=5)
    put_items(spark, [("a", 1, "x2", 10)])
    jobs.incremental(run_ts=6)
    assert content(jobs) == {"a_item_1": "x2", "a_item_2": "y"}
    jobs.full(run_ts=7)
    assert content(jobs) == {"a_item_1": "x2"}


def test_running_type_is_left_alone(spark, root):
    put_items(spark, [("a", 1, "x", 10), ("b", 1, "y", 10)])
    jobs = new_indexer(spark, root)
    busy = local_frame(spark, [("a", "item", "appa")], "tenant string, document_type string, appid string")
    jobs.state.start(busy, "Full", int(time.time()))
    report = jobs.full(run_ts=2)[0]
    assert (report.skipped, content(jobs)) == (("a",), {"b_item_1": "y"})
    assert state_of(jobs)[("a", "item")].status == "Running"
    assert jobs.full(tenant="a", run_ts=3)[0].status == "Skipped"


def test_dead_run_does_not_lock_out(spark, root):
    put_items(spark, [("a", 1, "x", 10)])
    jobs = new_indexer(spark, root)
    dead = local_frame(spark, [("a", "item", "appa")], "tenant string, document_type string, appid string")
    jobs.state.start(dead, "Full", int(time.time()) - jobs.stale_after - 5)
    assert jobs.full(run_ts=2)[0].skipped == () and content(jobs) == {"a_item_1": "x"}


def test_marks_on_dates_are_inclusive(spark, root):
    local_frame(spark, [("a", n, f"1998-01-0{n}") for n in (1, 2)], "tenant string, id bigint, day string").withColumn(
        "changed", F.col("day").cast("date")).createOrReplaceTempView("dated")
    index = IndexDef("dated", {"spark": "SELECT tenant, id, changed FROM dated"}, "id", "changed")
    noon = 883_612_800 + 12 * 3600
    rows = SharedTables(spark).rows(index, [Tenant("a"), Tenant("b")], {"a": noon, "b": 1})
    assert sorted(r.id for r in rows.collect()) == [1, 2]


def test_ids_with_fractions_are_set_aside(spark, root):
    rows = spark.sql("SELECT 'a' AS tenant, id, 'v' AS v, 1L AS changed FROM VALUES (1.2D), (1.7D), (3.0D) t(id)")
    rows.createOrReplaceTempView("items")
    jobs = new_indexer(spark, root)
    report = jobs.full(run_ts=1)[0]
    assert report.rows_quarantined == 2 and set(content(jobs)) == {"a_item_3"}


def test_text_ids_with_a_bad_value(spark, root):
    local_frame(spark, [("a", "1", "x", 1), ("a", "oops", "y", 1), ("a", "3", "z", 1)],
                "tenant string, id string, v string, changed bigint").createOrReplaceTempView("items")
    jobs = new_indexer(spark, root)
    jobs.selective("a", "item", [1, 7])
    assert set(content(jobs)) == {"a_item_1"}
    jobs.selective("a", "item", range(1, 3000))
    assert set(content(jobs)) == {"a_item_1", "a_item_3"}
    record = state_of(jobs)[("a", "item")]
    assert (record.status, record.last_index_type, record.last_indexed_at) == ("Completed", "Selective", None)
    jobs.selective("a", "item", [1], method="delete")
    assert set(content(jobs)) == {"a_item_3"}
    with pytest.raises(ValueError, match="neither"):
        jobs.selective("a", "item", [1], method="Remove")


def test_many_ids_bound_the_scan(spark, data):
    from docloom.sources import tables
    from docloom.suite import base as b

    orders = b.table(spark, data, "orders")
    text = tables.with_ids(orders, "o_orderkey", range(1000, 6000))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(o_orderkey,1000)" in text and "LessThanOrEqual(o_orderkey,5999)" in text


def test_log_keeps_what_arrives_during_a_poll(spark, root):
    from docloom.operators.snapshots import SnapshotTable

    put_items(spark, [("a", n, "old", 1) for n in range(3)])
    jobs = Indexer(spark, IndexSet((ITEM,), delete_records_after_indexing=True), TENANTS, SharedTables(spark), root)
    jobs.full(run_ts=1)
    log = SnapshotTable(spark, fresh_path(spark, "log"), ch.CHANGE_SCHEMA)
    first = log_rows(spark, [("a", "item", "DELETE", 1, 5, 1)])
    late = log_rows(spark, [("a", "item", "DELETE", 2, 6, 2)])
    log.write(first)
    apply = jobs.near_realtime

    def apply_while_one_arrives(batch):
        taken = apply(batch)
        log.write(first.unionByName(late))
        return taken

    jobs.near_realtime = apply_while_one_arrives
    assert jobs.poll(log) == 1
    assert [(r.object_id, r.seq) for r in log.read().collect()] == [(2, 2)]


def test_replayed_batch_keeps_one_quarantine_row(spark, root):
    jobs = new_indexer(spark, root)
    bad = log_rows(spark, [("a", "item", "REPAINT", 1, 5, 1)])
    for _ in range(2):
        jobs.near_realtime(bad, batch_id=4)
    assert jobs.bad_changes().count() == 1


def test_broker_order_within_a_second(spark):
    from docloom.streaming.feed import broker_order

    rows = spark.sql("""SELECT * FROM VALUES ('update', 100L, 0, 900L), ('delete', 900L, 1, 5L), ('later', 900L, 1, 6L),
                        ('other', 900L, 2, 1L) t(name, ms, part, off)""")
    order = broker_order(F.timestamp_millis(F.lit(1_700_000_000_000) + F.col("ms")), F.col("part"), F.col("off"))
    got = [r.name for r in rows.orderBy(order).collect()]
    assert got == ["update", "delete", "later", "other"]
    assert rows.select(F.min(order).alias("n")).first().n >= 0


def test_failure_keeps_documents_and_mark(spark, root):
    put_items(spark, [("a", 1, "x", 10)])
    jobs = new_indexer(spark, root)
    jobs.full(run_ts=5)
    local_frame(spark, [("a", 2, "x", 99)], "tenant string, id bigint, v string, changed bigint").withColumn(
        "v", F.raise_error(F.lit("source broke")).cast("string")).createOrReplaceTempView("items")
    report = jobs.incremental(run_ts=9)[0]
    assert report.status == "Failed" and "source broke" in report.error
    record = state_of(jobs)[("a", "item")]
    assert (record.status, record.last_indexed_at) == ("Failed", 5)
    assert content(jobs) == {"a_item_1": "x"}
    put_items(spark, [("a", 2, "y", 6)])
    jobs.incremental(run_ts=10)
    assert content(jobs) == {"a_item_1": "x", "a_item_2": "y"}


def test_selective(spark, root):
    put_items(spark, [("a", n, "x", 1) for n in range(5)] + [("off", 1, "x", 1)])
    jobs = new_indexer(spark, root)
    jobs.selective("a", "ITEM", [1, 2, 77])
    assert set(content(jobs)) == {"a_item_1", "a_item_2"}
    jobs.selective("a", "item", [2, 77], method="Delete")
    assert set(content(jobs)) == {"a_item_1"}
    assert jobs.selective("off", "item", [1]) is None
    assert jobs.selective("nobody", "item", [1]) is None
    with pytest.raises(KeyError):
        jobs.selective("a", "ghost", [1])


def test_standalone_delete_restarts_incremental(spark, root):
    put_items(spark, [("a", 1, "x", 10), ("b", 1, "y", 10)])
    jobs = new_indexer(spark, root)
    jobs.full(run_ts=100)
    jobs.delete("item", "a")
    assert content(jobs) == {"b_item_1": "y"} and state_of(jobs)[("a", "item")].status == "Deleted"
    jobs.incremental(run_ts=200)
    assert content(jobs) == {"a_item_1": "x", "b_item_1": "y"}


def log_rows(spark, rows):
    return local_frame(spark, rows, ch.CHANGE_SCHEMA)


def test_near_realtime_precedence_and_taken_rows(spark, root):
    put_items(spark, [("a", n, "old", 1) for n in range(4)] + [("b", n, "old", 1) for n in range(4)])
    put_notes(spark, [("a", 1), ("b", 1)])
    jobs = new_indexer(spark, root, ITEM, NOTE)
    jobs.full(tenant="a", run_ts=1)
    put_items(spark, [("a", n, "new", 1) for n in range(4)])
    taken = jobs.near_realtime(log_rows(spark, [
        ("a", "Item", "UPDATE", 1, 5, 1), ("a", "item", "DELETE", 2, 5, 2), ("a", "item", "UPDATE", 99, 5, 3),
        ("a", "note", "BULKDELETE", None, 5, 4), ("a", "note", "UPDATE", 1, 6, 5), ("a", "ghost", "UPDATE", 1, 6, 6),
        ("b", "item", "DELETE", 1, 6, 7), ("a", "item", "SING", 3, 6, 8), (None, "item", "DELETE", 3, 6, 9)]))
    assert content(jobs) == {"a_item_0": "old", "a_item_1": "new", "a_item_3": "old"}
    assert jobs.index.table("note").documents().count() == 0
    assert sorted(r.seq for r in taken.collect()) == [1, 2, 3, 4, 5, 6, 8, 9]
    assert sorted(r.seq for r in jobs.bad_changes().collect()) == [8, 9]
    states = {key: r.status for key, r in state_of(jobs).items()}
    assert states == {("a", "item"): "Completed", ("a", "note"): "Deleted"}
    jobs.near_realtime(log_rows(spark, [("a", "item", "SliceDeprovisioned", None, 7, 1), ("a", "item", "UPDATE", 1, 8, 2)]))
    assert content(jobs) == {} and state_of(jobs)[("a", "item")].status == "Deleted"


def random_log(seed, count=80):
    rng = random.Random(seed)
    return [("a" if rng.random() < 0.7 else "b", "item", rng.choice(["UPDATE", "CREATE", "DELETE"]),
             rng.randrange(15), rng.randrange(30), seq) for seq in range(count)]


def indexed(spark, root):
    put_items(spark, [(t, n, "old", 1) for t in "ab" for n in range(60)])
    jobs = new_indexer(spark, root)
    jobs.full(run_ts=1)
    put_items(spark, [(t, n, "new", 1) for t in "ab" for n in range(60)])
    return jobs


def test_batches_replays_and_disorder_agree(spark, root):
    log = random_log(3)
    whole = indexed(spark, root + "1")
    whole.near_realtime(log_rows(spark, log))
    latest = {}
    for event in sorted(log, key=lambda e: (e[4], e[5])):
        latest[f"{event[0]}_item_{event[3]}"] = event[2]
    want = {f"{t}_item_{n}": "old" for t in "ab" for n in range(60)}
    want.update({k: "new" for k in latest})
    want = {k: v for k, v in want.items() if latest.get(k) != "DELETE"}
    assert content(whole) == want
    parts = indexed(spark, root + "2")
    random.Random(5).shuffle(log)
    for start in (0, 20, 40, 20, 60, 0):
        parts.near_realtime(log_rows(spark, log[start : start + 20]))
    assert content(parts) == want


def test_message_stream_equals_one_batch(spark, root):
    log = random_log(11, 60)
    whole = indexed(spark, root + "1")
    whole.near_realtime(log_rows(spark, log))
    landing = fresh_path(spark, "feed")
    for start in (0, 20, 40):
        texts = [(json.dumps({"tenant_id": t, "object_code": c, "operation_type": o, "object_id": i}), at, seq)
                 for t, c, o, i, at, seq in log[start : start + 20]]
        frame = local_frame(spark, texts, "value string, at bigint, seq bigint")
        frame.coalesce(1).write.mode("append").parquet(landing)
    jobs = indexed(spark, root + "2")
    batches = []
    stream = file_changes(spark, landing, frame.schema, files_per_batch=1)
    changes = message_changes(stream, "value", F.timestamp_seconds("at"), F.col("seq"))
    query = run_change_stream(
        changes, lambda df: batches.append(jobs.near_realtime(df).count()), fresh_path(spark, "offsets"))
    query.awaitTermination()
    assert batches == [20, 20, 20]
    assert content(jobs) == content(whole)


def test_tenant_tables_use_their_own_rows_and_text(spark, root):
    index = IndexDef("item", {"mysql": "SELECT id, 'm' AS v FROM mine", "oracle": "SELECT ID, 'o' AS V, 1 AS extra FROM mine"}, "id",
                     mapping={"v": {"type": "keyword"}})
    tenants = [Tenant("a", vendor="MySQL"), Tenant("b", vendor="Oracle")]
    source = TenantTables(spark, lambda t: {"mine": spark.range(ord(t.id), ord(t.id) + 2)})
    jobs = Indexer(spark, IndexSet((index,)), tenants, source, root)
    jobs.full()
    assert content(jobs) == {"a_item_97": "m", "a_item_98": "m", "b_item_98": "o", "b_item_99": "o"}
    assert not spark.catalog.tableExists("mine")


def test_staged_rows_give_the_same_result(spark, root):
    put_items(spark, [("a", n, "x", 1) for n in range(20)])
    staged = IndexDef("item", ITEM.queries, "id", mapping=ITEM.mapping, stage_rows=True)
    jobs = new_indexer(spark, root, staged)
    jobs.full()
    assert len(content(jobs)) == 20


def test_jdbc_options():
    where = {"host": "h", "port": "1", "schema": "s", "user": "u"}
    urls = {v: jdbc_options(Tenant("t", vendor=v, source=where), "SELECT 1;")["url"] for v in ("MySQL", "mssql", "ORACLE")}
    assert urls == {"MySQL": "jdbc:mysql://h:1/s", "mssql": "jdbc:sqlserver://h:1;databaseName=s", "ORACLE": "jdbc:oracle:thin:@h:1:s"}
    plain = jdbc_options(Tenant("t", source={"url": "jdbc:x"}), "SELECT 1;")
    assert plain == {"url": "jdbc:x", "query": "SELECT 1"}
    split = {"url": "jdbc:x", "partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "3"}
    assert jdbc_options(Tenant("t", source=split), "SELECT 1")["dbtable"] == "(SELECT 1) q"
    with pytest.raises(ValueError, match="unknown vendor"):
        jdbc_options(Tenant("t", vendor="none", source=where), "SELECT 1")
    with pytest.raises(ValueError, match="split read needs"):
        jdbc_options(Tenant("t", source={"url": "u", "partitionColumn": "id"}), "SELECT 1")


def test_binary_documents(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(bytes(range(256)))
    (tmp_path / "skip.txt").write_text("no")
    first = binary_documents(spark, str(tmp_path), "*.bin").collect()
    again = binary_documents(spark, str(tmp_path), "*.bin").collect()
    assert first == again and len(first) == 1 and first[0].doc_id.startswith("att-")
    import base64

    assert base64.b64decode(json.loads(first[0].source)["data"]) == bytes(range(256))


def test_poll_takes_rows_off_the_log(spark, root):
    from docloom.operators.snapshots import SnapshotTable

    put_items(spark, [("a", n, "old", 1) for n in range(4)])
    put_notes(spark, [("a", 1)])
    for keep, left in ((False, 3), (True, 1)):
        jobs = Indexer(spark, IndexSet((ITEM,), delete_records_after_indexing=keep), TENANTS, SharedTables(spark), f"{root}{keep}")
        jobs.full(tenant="a", run_ts=1)
        log = SnapshotTable(spark, fresh_path(spark, "log"), ch.CHANGE_SCHEMA)
        log.write(log_rows(spark, [("a", "item", "DELETE", 1, 5, 1), ("b", "item", "DELETE", 2, 5, 2), ("a", "ghost", "DELETE", 2, 5, None)]))
        assert jobs.poll(log) == 2
        assert log.read().count() == left
        assert jobs.poll(log) == (0 if keep else 2)
        assert set(content(jobs)) == {"a_item_0", "a_item_2", "a_item_3"}
    assert jobs.vacuum(older_than=0) > 0 and set(content(jobs)) == {"a_item_0", "a_item_2", "a_item_3"}


def test_own_tables_apply_each_tenants_mark(spark, root):
    index = IndexDef("item", {"spark": "SELECT id, id AS changed FROM mine"}, "id", "changed")
    source = TenantTables(spark, lambda t: {"mine": spark.range(10)})
    tenants = [Tenant("a"), Tenant("b")]
    got = source.rows(index, tenants, {"a": 0, "b": 7})
    assert {r.tenant: r["count"] for r in got.groupBy("tenant").count().collect()} == {"a": 10, "b": 3}


def test_new_tenant_does_not_lift_the_bound_of_others(spark, data):
    from docloom.suite import base as b

    b.register_tables(spark, data, "orders")
    marks = {"tenant0": 0, "tenant1": 883_612_800, "tenant2": 983_612_800}
    rows = SharedTables(spark).rows(b.ORDER, b.FOUR_TENANTS[:3], marks)
    want = spark.sql(
        "SELECT count(*) FROM orders WHERE o_orderkey % 4 = 0 OR (o_orderkey % 4 = 1 AND o_orderdate >= '1998-01-01') "
        "OR (o_orderkey % 4 = 2 AND unix_seconds(CAST(o_orderdate AS timestamp)) >= 983612800)").first()[0]
    assert rows.count() == want


def test_of_two_runs_that_start_together_one_gets_the_pair(spark, root):
    """Both look at the state before either has written."""
    from concurrent.futures import ThreadPoolExecutor

    from docloom.operators import state as st

    pairs = local_frame(spark, [("a", "item", "appa"), ("b", "item", "appb")], "tenant string, document_type string, appid string")
    state = st.RunState(spark, fresh_path(spark, "state"))
    with ThreadPoolExecutor(2) as pool:
        taken = list(pool.map(lambda _: state.take(pairs, "Full", int(time.time()), since=0), range(2)))
    assert sorted(map(len, taken)) == [0, 2]
    assert [r.status for r in state.read().collect()] == ["Running"] * 2


def test_state_written_meanwhile_is_kept(spark, root):
    from docloom.operators import state as st

    pair = "tenant string, document_type string, appid string"
    one, two = (local_frame(spark, [(t, "item", None)], pair) for t in "ab")
    state = st.RunState(spark, fresh_path(spark, "state"))
    state.start(one, "Full", 1)
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda job: state.finish(*job), [(two, "Full", 5), (one, "Full", 7)]))
    assert {r.tenant: (r.status, r.last_indexed_at) for r in state.read().collect()} == {"a": ("Completed", 7), "b": ("Completed", 5)}


def test_a_failed_selective_run_leaves_a_trace(spark, root):
    put_items(spark, [("a", 1, "x", 10)])
    jobs = new_indexer(spark, root)
    jobs.full(run_ts=5)
    local_frame(spark, [("a", 1, "x", 99)], "tenant string, id bigint, v string, changed bigint").withColumn(
        "v", F.raise_error(F.lit("source broke")).cast("string")).createOrReplaceTempView("items")
    with pytest.raises(Exception, match="source broke"):
        jobs.selective("a", "item", [1])
    record = state_of(jobs)[("a", "item")]
    assert (record.status, record.last_index_type, record.last_indexed_at) == ("Failed", "Selective", 5)


def test_a_replayed_micro_batch_gives_no_new_version(spark, root):
    """A batch that was applied before the checkpoint knew of it is recognised by stream and number."""
    put_items(spark, [("a", n, "old", 1) for n in range(40)])
    jobs = new_indexer(spark, root)
    jobs.full(run_ts=1)
    put_items(spark, [("a", n, "new", 1) for n in range(40)])
    batch = log_rows(spark, [("a", "item", "UPDATE", 1, 5, 1)])
    table = jobs.index.table("item")
    jobs.near_realtime(batch, batch_id=0, stream="s")
    number = table.snapshots.latest()
    jobs.near_realtime(batch, batch_id=0, stream="s")
    assert table.snapshots.latest() == number and content(jobs)["a_item_1"] == "new"
    jobs.near_realtime(batch, batch_id=1, stream="s")
    assert table.snapshots.latest() == number + 1


def test_a_stream_names_its_batches(spark, root):
    put_items(spark, [("a", n, "v", 1) for n in range(40)])
    jobs = new_indexer(spark, root)
    jobs.full(run_ts=1)
    folder = fresh_path(spark, "feed")
    log_rows(spark, [("a", "item", "DELETE", 3, 5, 1)]).write.parquet(folder)
    changes = file_changes(spark, folder, ch.CHANGE_SCHEMA)
    run_change_stream(changes, jobs.near_realtime, fresh_path(spark, "offsets")).awaitTermination()
    assert "a_item_3" not in content(jobs)
    marks = jobs.index.table("item").snapshots.read().where("stream IS NOT NULL").collect()
    assert [m.batch for m in marks] == [0] and len(marks[0].stream) == 36
