"""The document table: merges, deltas, buckets, odd tenants."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.operators import store
from docloom.operators.store import Conflict, DocumentTable
from docloom.workspace import Stage, local_frame

FIELDS = T.StructType([T.StructField("v", T.LongType())])
ROWS = (
    "tenant string, doc_id string, parent_key string, source string, changed_at bigint, "
    "changed_seq bigint, deleted boolean, doc struct<v:bigint>, from_run boolean"
)


def row(tenant, number, value, at=None, seq=None, deleted=False, run=True):
    doc_id = None if number is None else f"{tenant}_t_{number}"
    return (tenant, doc_id, None, None if deleted else str(value), at, seq, deleted,
            None if deleted else {"v": value}, run)


def frame(spark, rows):
    return local_frame(spark, rows, ROWS)


def content(table):
    return {r.doc_id: r.doc.v for r in table.documents().collect()}


def table_at(spark, root, target=1000):
    return DocumentTable(spark, root, "t", FIELDS, target_rows=target)


def test_upsert_replaces_and_adds(spark, root):
    table = table_at(spark, root)
    table.upsert(frame(spark, [row("a", 1, 1), row("a", 2, 2), row("b", 1, 3)]))
    table.upsert(frame(spark, [row("a", 2, 20), row("a", 3, 30)]))
    assert content(table) == {"a_t_1": 1, "a_t_2": 20, "a_t_3": 30, "b_t_1": 3}
    table.upsert(frame(spark, [row("a", 2, 20), row("a", 3, 30)]))
    assert content(table) == {"a_t_1": 1, "a_t_2": 20, "a_t_3": 30, "b_t_1": 3}


def test_untouched_parts_stay(spark, root):
    table = table_at(spark, root, target=50)
    table.upsert(frame(spark, [row("a", n, n) for n in range(400)] + [row("b", 1, 1)]))
    before = {r.part for r in table.manifest().collect()}
    assert len(before) > 4
    table.upsert(frame(spark, [row("a", 7, 70)]))
    after = {r.part: r.delta for r in table.manifest().collect()}
    assert before < set(after) and [after[part] for part in after.keys() - before] == [True]
    assert content(table)["a_t_7"] == 70 and len(content(table)) == 401


def test_large_tenant_gets_more_buckets_and_is_spread_anew(spark, root):
    table = table_at(spark, root, target=20)
    table.upsert(frame(spark, [row("big", n, n) for n in range(30)] + [row("small", 1, 1)]))
    first = {r.tenant: r.buckets for r in table.manifest().collect()}
    assert first == {"big": 2, "small": 1}
    table.upsert(frame(spark, [row("big", n, n) for n in range(30, 600)]))
    second = {r.tenant: r.buckets for r in table.manifest().collect()}
    assert second == {"big": 32, "small": 1}
    assert content(table) == {**{f"big_t_{n}": n for n in range(600)}, "small_t_1": 1}


def test_large_part_is_sorted_and_written_in_pieces(spark, root, monkeypatch):
    """One part of many pieces, of rows or of bytes: no task sorts the whole, and each id keeps one row."""
    monkeypatch.setattr(store, "PIECE_ROWS", 20)
    table = table_at(spark, root)
    rows = [row("a", n, n) for n in range(400)]
    with Stage(spark) as stage:
        plan = table._plan(frame(spark, rows), table.manifest(), stage)
        placed = table._pick(table._arriving(frame(spark, rows)), plan, "v").groupBy(F.spark_partition_id()).count()
        sizes = [r["count"] for r in placed.collect()]
    assert plan.parts == 20 and sum(sizes) == 400 and max(sizes) < 200
    table.upsert(frame(spark, rows * 2))
    assert len(table.manifest().collect()) == 1 and len(table.documents().inputFiles()) > 5
    table.upsert(frame(spark, [row("a", n, -n) for n in range(100, 500)]))
    want = {f"a_t_{n}": n if n < 100 else -n for n in range(500)}
    assert content(table) == want and [r.delta for r in table.manifest().collect()] == [False]
    monkeypatch.setattr(store, "PIECE_ROWS", 2)
    table.apply(frame(spark, [row("a", n, 7, at=5, seq=n, run=False) for n in range(20)] + [row("a", 3, 0, at=9, seq=1, deleted=True, run=False)]))
    want |= {f"a_t_{n}": 7 for n in range(20)}
    del want["a_t_3"]
    assert content(table) == want and sorted(r.delta for r in table.manifest().collect()) == [False, True]
    monkeypatch.setattr(store, "PIECE_BYTES", 100)
    monkeypatch.setattr(store, "PIECE_ROWS", 1000)
    wide = frame(spark, rows).withColumn("source", F.repeat("source", 20))
    with Stage(spark) as stage:
        assert table_at(spark, f"{root}/wide")._plan(wide, table.manifest().limit(0), stage).parts > 100


def test_hot_id_is_reduced_exactly(spark, root):
    """A third of all rows carry one id; the newest event of it wins."""
    table = table_at(spark, root, target=100)
    rows = [row("a", n, n, at=1, run=False) for n in range(300)]
    rows += [row("a", 5, 1000 + n, at=n + 2, run=False) for n in range(300)]
    random.Random(1).shuffle(rows)
    with Stage(spark) as stage:
        assert table._plan(frame(spark, rows), table.manifest(), stage).hot_slices == 1
    table.upsert(frame(spark, rows))
    assert content(table) == {**{f"a_t_{n}": n for n in range(300)}, "a_t_5": 1299}


def test_delete_of_the_last_row_empties_a_bucket(spark, root):
    table = table_at(spark, root)
    table.upsert(frame(spark, [row("a", 1, 1), row("b", 1, 2)]))
    table.delete_ids(local_frame(spark, [("a", "a_t_1")], "tenant string, doc_id string"))
    assert content(table) == {"b_t_1": 2}
    assert [r.tenant for r in table.manifest().collect()] == ["b"]


def test_replace_drops_what_the_source_lost(spark, root):
    table = table_at(spark, root)
    tenants = local_frame(spark, [("a",), ("b",)], "tenant string")
    table.replace(frame(spark, [row("a", 1, 1), row("b", 1, 2), row("c", 1, 3)]), tenants)
    table.replace(frame(spark, [row("a", 2, 5)]), tenants)
    assert content(table) == {"a_t_2": 5, "c_t_1": 3}


@pytest.mark.parametrize("tenant", ["007", "1e5", "a b/c=d%e", "Ünï", "true", "2024-01-01"])
def test_tenant_names_survive_the_folder_layout(spark, root, tenant):
    table = table_at(spark, root)
    table.upsert(frame(spark, [row(tenant, 1, 1), row("7", 1, 2)]))
    table.upsert(frame(spark, [row(tenant, 2, 3)]))
    found = {(r.tenant, r.doc_id) for r in table.documents().collect()}
    assert found == {(tenant, f"{tenant}_t_1"), (tenant, f"{tenant}_t_2"), ("7", "7_t_1")}


def test_quarantine_keeps_rows_without_id(spark, root):
    table = table_at(spark, root)
    report = table.upsert(frame(spark, [row("a", 1, 1), row("a", None, 9)]))
    assert (report.rows_in, report.rows_quarantined) == (2, 1)
    assert [r.source for r in table.quarantined().collect()] == ["9"]
    assert content(table) == {"a_t_1": 1}


def test_few_events_become_a_delta_and_fold_later(spark, root):
    table = table_at(spark, root)
    table.upsert(frame(spark, [row("a", n, n) for n in range(200)]))
    table.apply(frame(spark, [row("a", 1, 100, at=10, run=False), row("a", 2, 0, at=10, deleted=True, run=False),
                              row("a", 900, 900, at=10, run=False)]))
    assert table.manifest().where("delta").count() == 1
    want = {f"a_t_{n}": n for n in range(200) if n != 2} | {"a_t_1": 100, "a_t_900": 900}
    assert content(table) == want
    assert table.counts().first().documents == len(want)
    table.upsert(frame(spark, [row("a", 5, 50)]))
    assert table.manifest().where("delta").count() == 2
    table.upsert(frame(spark, [row("a", n, n) for n in range(20, 40)]))
    assert table.manifest().where("delta").count() == 0
    assert content(table) == want | {"a_t_5": 50}


@pytest.mark.parametrize("named", [1000, 0])
def test_late_events_lose_in_any_batching(spark, root, monkeypatch, named):
    """Random events, cut into commits at random and applied out of order, against brute force."""
    monkeypatch.setattr(store, "NAMED_PARTS", named)
    monkeypatch.setattr(store, "DELTA_PARTS", 2)
    rng = random.Random(7)
    start = [row("a", n, n) for n in range(120)]
    events = []
    for seq in range(60):
        number, deleted = rng.randrange(12), rng.random() < 0.4
        events.append(row("a", number, 1000 + seq, at=rng.randrange(20), seq=seq, deleted=deleted, run=False))
    rng.shuffle(events)
    want = {f"a_t_{n}": n for n in range(120)}
    latest = {}
    for event in events:
        key = (event[4], event[5])
        if event[1] not in latest or key > latest[event[1]][0]:
            latest[event[1]] = (key, event)
    for doc_id, (_, event) in latest.items():
        want[doc_id] = None if event[6] else event[7]["v"]
    want = {doc_id: value for doc_id, value in want.items() if value is not None}

    table = table_at(spark, root, target=30)
    table.upsert(frame(spark, start))
    position, commits = 0, 0
    while position < len(events):
        size = rng.choice([1, 2, 3, 20])
        table.apply(frame(spark, events[position : position + size]))
        position, commits = position + size, commits + 1
    assert commits > 5
    assert content(table) == want


def test_small_merge_into_a_wide_table_runs_few_tasks(spark, root):
    table = table_at(spark, root, target=20)
    table.upsert(frame(spark, [row("a", n, n) for n in range(600)]))
    with Stage(spark) as stage:
        plan = table._plan(frame(spark, [row("a", 1, 1), row("a", 2, 2)]), table.manifest(), stage)
    assert plan.parts <= 2


def test_run_keeps_the_event_mark(spark, root):
    """A run overwrites the document, and a delete older than the last event still loses."""
    table = table_at(spark, root)
    table.upsert(frame(spark, [row("a", 1, 1)]))
    table.apply(frame(spark, [row("a", 1, 2, at=10, run=False)]))
    table.upsert(frame(spark, [row("a", 1, 3)]))
    table.apply(frame(spark, [row("a", 1, 0, at=8, deleted=True, run=False)]))
    assert content(table) == {"a_t_1": 3}
    table.apply(frame(spark, [row("a", 1, 0, at=11, deleted=True, run=False)]))
    assert content(table) == {}


def test_failed_commit_leaves_the_old_version(spark, root):
    table = table_at(spark, root)
    table.upsert(frame(spark, [row("a", 1, 1)]))
    bad = frame(spark, [row("a", 2, 2)]).withColumn("parent_key", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        table.upsert(bad)
    assert content(table) == {"a_t_1": 1}
    table.upsert(frame(spark, [row("a", 3, 3)]))
    assert content(table) == {"a_t_1": 1, "a_t_3": 3}


def test_vacuum_removes_only_dead_parts(spark, root):
    table = table_at(spark, root)
    for value in range(3):
        table.upsert(frame(spark, [row("a", 1, value), row("b", value, value)]))
    want = content(table)
    assert table.vacuum() == 0  # what is young may belong to a commit under way
    assert table.vacuum(older_than=0) > 0
    assert content(table) == want
    assert table.vacuum(older_than=0) == 0


def test_vacuum_beside_a_commit_loses_nothing(spark, root, monkeypatch):
    """Parts that vanish before they are published stop the commit."""
    table = table_at(spark, root)
    table.upsert(frame(spark, [row("a", 1, 1)]))
    write = table._write

    def write_and_clean(rows, plan, version):
        written = write(rows, plan, version)
        table.vacuum(older_than=0)
        return written

    monkeypatch.setattr(table, "_write", write_and_clean)
    with pytest.raises(Exception, match="rows were written|PATH_NOT_FOUND|UNABLE_TO_INFER"):
        table.upsert(frame(spark, [row("a", 2, 2), row("a", 3, 3)]))
    monkeypatch.undo()
    assert content(table) == {"a_t_1": 1}


@pytest.mark.parametrize("target", [2, 1000])
def test_marks_of_repeated_ids_do_not_depend_on_size(spark, root, target):
    """A run, a pending event and a late delete give one table, whatever the bucket size."""
    table = table_at(spark, root, target=target)
    table.upsert(frame(spark, [row("a", n, n) for n in range(60)]))
    table.apply(frame(spark, [row("a", 7, 70, at=100, seq=1, run=False)]))
    table.upsert(frame(spark, [row("a", 7, 71)] * 5))
    assert {r.doc_id: r.changed_at for r in table.rows().collect()}["a_t_7"] == 100
    table.apply(frame(spark, [row("a", 7, 0, at=50, seq=9, deleted=True, run=False)]))
    assert content(table)["a_t_7"] == 71 and len(content(table)) == 60


def test_replace_evaluates_its_rows_once(spark, root):
    """Tenants, counts and rows come from one reading of a source that moves on."""
    rows = frame(spark, [row("a", 1, 1), row("b", 1, 2)])
    dice = rows.withColumn("tenant", F.when(F.rand() < 0.5, "x").otherwise("y"))
    table = table_at(spark, root)
    report = table.replace(dice, local_frame(spark, [("x",), ("y",)], "tenant string"))
    assert report.rows_in == 2 == sum(r.rows for r in table.manifest().collect())


def test_create_and_drop(spark, root):
    table = table_at(spark, root)
    assert table.create() and not table.create()
    assert content(table) == {}
    assert table.drop() and not table.exists()


def test_the_batch_table_has_every_tenant(spark, root, monkeypatch):
    """As with more than ``FEW_TENANTS`` tenants, whose layout is kept in a file."""
    from docloom.model import IndexDef, IndexSet, Tenant
    from docloom.plans.indexer import Indexer
    from docloom.sources.tables import SharedTables

    monkeypatch.setattr(store, "FEW_TENANTS", 2)
    spark.range(50).selectExpr("concat('n', id % 5) AS tenant", "if(id < 5, NULL, id) AS id").createOrReplaceTempView("of_many")
    kind = IndexDef("thing", {"spark": "SELECT tenant, id FROM of_many"}, "id")
    tenants = [Tenant(f"n{i}") for i in range(5)]
    report = Indexer(spark, IndexSet((kind,), batch_count=4), tenants, SharedTables(spark), root).full(run_ts=1)[0]
    assert report.error is None
    timed = report.batch_table(spark)
    assert all(r.took_ms > 0 and 0 < r.ms_per_document <= r.took_ms for r in timed.collect())
    rows = sorted(tuple(r)[:6] for r in timed.collect())
    assert rows == [(f"n{i}", "thing", 9, report.batch_size, -(-9 // report.batch_size), 1) for i in range(5)]


def test_one_row_with_deltas_pending_rewrites_no_base_part(spark, root, monkeypatch):
    """Whatever lies in the deltas, a commit writes its own rows; only the group that is due is folded."""
    monkeypatch.setattr(store, "DELTA_SHARE", 3)
    table = table_at(spark, root, target=50)
    table.upsert(frame(spark, [row("a", n, n) for n in range(3000)]))
    base = {r.part for r in table.manifest().collect()}
    assert len(base) == 64
    report = table.apply(frame(spark, [row("a", n, -n, at=5, run=False) for n in range(100)]))
    assert report.parts_written == 0
    report = table.upsert(frame(spark, [row("a", 7, 70)]))
    assert report.parts_written == 0
    entries = table.manifest().collect()
    assert {r.part for r in entries if not r.delta} == base
    assert sum(r.rows for r in entries if r.delta) == 101
    want = {f"a_t_{n}": -n if n < 100 else n for n in range(3000)} | {"a_t_7": 70}
    assert content(table) == want
    slice_no = F.pmod(store.slice_of(F.col("doc_id")), F.lit(64))
    group = {r.doc_id: r.g for r in table.documents().select("doc_id", slice_no.alias("g")).collect()}
    mine = [n for n in range(100, 3000) if group[f"a_t_{n}"] == group["a_t_7"]]
    report = table.upsert(frame(spark, [row("a", n, n + 1) for n in mine]))
    assert report.parts_written == 1
    entries = table.manifest().collect()
    assert len(base - {r.part for r in entries}) == 1
    assert not any(r.delta and r.bucket == group["a_t_7"] for r in entries)
    assert content(table) == want | {f"a_t_{n}": n + 1 for n in mine}


def folded(commits):
    """What a list of commits of (rows, by events) leaves, one row after the other."""
    state = {}
    for rows in commits:
        for _, doc_id, _, _, at, seq, deleted, doc, run in sorted(rows, key=lambda r: (not r[8], r[4] or -1, r[5] or -1, r[6])):
            mark, _, _ = state.get(doc_id, ((-1, -1), None, None))
            new = (-1 if at is None else at, -1 if seq is None else seq)
            if run:
                state[doc_id] = (max(mark, new), None if deleted else doc["v"], deleted)
            elif new > mark or new == mark and deleted >= bool(state.get(doc_id, (0, 0, False))[2]):
                state[doc_id] = (new, None if deleted else doc["v"], deleted)
    return {doc_id: value for doc_id, (_, value, _) in state.items() if value is not None}


@pytest.mark.parametrize("seed, parts, share", [(1, 32, 1), (2, 3, 3), (3, 2, 20)])
def test_runs_and_events_in_deltas_equal_one_after_the_other(spark, root, monkeypatch, seed, parts, share):
    """Runs beat what came before them, and events after a run only what they are newer than."""
    monkeypatch.setattr(store, "DELTA_PARTS", parts)
    monkeypatch.setattr(store, "DELTA_SHARE", share)
    rng = random.Random(seed)
    table = table_at(spark, root, target=40)
    commits = [[row("a", n, n) for n in range(150)]]
    for seq in range(14):
        run = rng.random() < 0.45
        numbers = rng.sample(range(8), rng.randrange(1, 4))
        one = []
        for k, n in enumerate(numbers):
            gone = not run and rng.random() < 0.3
            at, place = (None, None) if run else (rng.randrange(30), 10 * seq + k)
            one.append(row("a", n, 1000 * seq + n, at=at, seq=place, deleted=gone, run=run))
        commits.append(one)
    for number, commit in enumerate(commits):
        (table.upsert if commit[0][8] else table.apply)(frame(spark, commit))
        if number % 5 == 4:
            assert content(table) == folded(commits[: number + 1])
    assert content(table) == folded(commits)
    entries = table.manifest().collect()
    assert any(r.delta for r in entries) or parts == 2
    counts = table.counts().first()
    assert counts.documents == len(folded(commits))


def overtaken(table, monkeypatch, other):
    """Run ``other`` on the table after the first write of the next commit, before it is published."""
    write, waiting = table._write, [other]

    def write_then_other(rows, plan, version):
        seen = write(rows, plan, version)
        if waiting:
            waiting.pop()()
        return seen

    monkeypatch.setattr(table, "_write", write_then_other)


def test_a_commit_published_meanwhile_is_kept(spark, root, monkeypatch):
    table, second = table_at(spark, root), table_at(spark, root)
    table.upsert(frame(spark, [row("a", n, n) for n in range(100)]))
    overtaken(table, monkeypatch, lambda: second.upsert(frame(spark, [row("a", 1, 100)])))
    table.upsert(frame(spark, [row("a", 2, 200)]))
    assert content(table) == {f"a_t_{n}": n for n in range(100)} | {"a_t_1": 100, "a_t_2": 200}


@pytest.mark.parametrize("mine, other", [(50, 50), (50, 1), (1, 50)])
def test_folds_that_meet_are_merged_again(spark, root, monkeypatch, mine, other):
    """Large commits fold the one group there is; whichever comes later merges again."""
    table, second = table_at(spark, root), table_at(spark, root)
    table.upsert(frame(spark, [row("a", n, n) for n in range(100)]))
    overtaken(table, monkeypatch, lambda: second.upsert(frame(spark, [row("a", n, n + 500) for n in range(other)])))
    table.upsert(frame(spark, [row("a", n, n + 900) for n in range(90, 90 + mine)]))
    want = {f"a_t_{n}": n for n in range(100)} | {f"a_t_{n}": n + 500 for n in range(other)}
    assert content(table) == want | {f"a_t_{n}": n + 900 for n in range(90, 90 + mine)}
    assert table.counts().first().documents == max(100, 90 + mine)


def test_two_first_commits_of_a_tenant_make_one_base(spark, root, monkeypatch):
    table, second = table_at(spark, root), table_at(spark, root)
    table.create()
    overtaken(table, monkeypatch, lambda: second.upsert(frame(spark, [row("a", 1, 1), row("b", 1, 1)])))
    table.upsert(frame(spark, [row("a", 1, 5), row("a", 2, 6)]))
    assert content(table) == {"a_t_1": 5, "a_t_2": 6, "b_t_1": 1}
    assert table.rows().count() == 3


def test_events_that_overtake_a_full_run_stay(spark, root, monkeypatch):
    """A delete and an update that were folded while the run wrote are newer than what it read."""
    table, second = table_at(spark, root), table_at(spark, root)
    tenants = local_frame(spark, [("a",)], "tenant string")
    table.replace(frame(spark, [row("a", n, n) for n in range(6)]), tenants)
    events = [row("a", 1, 0, at=9, deleted=True, run=False), row("a", 2, 22, at=9, run=False), row("a", 9, 99, at=9, run=False)]
    overtaken(table, monkeypatch, lambda: second.apply(frame(spark, events)))
    table.replace(frame(spark, [row("a", n, n + 10) for n in range(5)]), tenants)
    assert content(table) == {"a_t_0": 10, "a_t_2": 22, "a_t_3": 13, "a_t_4": 14, "a_t_9": 99}


def test_threads_that_write_at_once_lose_nothing(spark, root):
    from concurrent.futures import ThreadPoolExecutor

    table_at(spark, root).upsert(frame(spark, [row("a", n, n) for n in range(60)]))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: table_at(spark, root).upsert(frame(spark, [row("a", 100 + n, n), row(f"t{n}", 1, n)])), range(4)))
    want = {f"a_t_{n}": n for n in range(60)} | {f"a_t_{100 + n}": n for n in range(4)} | {f"t{n}_t_1": n for n in range(4)}
    assert content(table_at(spark, root)) == want


def test_a_claim_of_a_dead_writer_is_passed_over(spark, root, monkeypatch):
    from docloom.operators import snapshots
    from docloom.workspace import file_system

    table = table_at(spark, root)
    table.upsert(frame(spark, [row("a", 1, 1)]))
    fs, claim = file_system(spark, table.snapshots._claim_path(table.snapshots.latest() + 1))
    fs.createNewFile(claim)
    monkeypatch.setattr(snapshots, "CLAIM_AGE", 0.0)
    table.upsert(frame(spark, [row("a", 2, 2)]))
    assert content(table) == {"a_t_1": 1, "a_t_2": 2}


def test_a_second_full_run_of_the_same_rows_writes_no_part(spark, root):
    table = table_at(spark, root, target=50)
    tenants = local_frame(spark, [("a",), ("b",)], "tenant string")
    rows = [row("a", n, n) for n in range(400)] + [row("b", 1, 1)]
    assert table.replace(frame(spark, rows), tenants).parts_written == 9
    parts = {r.part for r in table.manifest().collect()}
    random.Random(2).shuffle(rows)
    assert table.replace(frame(spark, rows), tenants).parts_written == 0
    assert {r.part for r in table.manifest().collect()} == parts
    changed = [row("a", 7, 70) if r[1] == "a_t_7" else r for r in rows if r[0] == "a"]
    assert table.replace(frame(spark, changed), tenants).parts_written == 1
    assert content(table) == {f"a_t_{n}": n for n in range(400)} | {"a_t_7": 70}


def test_buckets_follow_bytes(spark, root, monkeypatch):
    """Documents of a megabyte get as many buckets and files as their bytes call for."""
    monkeypatch.setattr(store, "TARGET_FILE_BYTES", 4 << 20)
    table = DocumentTable(spark, root, "t", FIELDS, target_rows=1000, target_bytes=8 << 20)
    rows = frame(spark, [row("a", n, n) for n in range(64)] + [row("b", 1, 1)])
    wide = rows.withColumn("source", F.when(F.col("tenant") == "a", F.repeat(F.col("source"), 1 << 19)).otherwise(F.col("source")))
    table.upsert(wide)
    entries = table.manifest().collect()
    assert {r.tenant: r.buckets for r in entries} == {"a": 8, "b": 1}
    assert sum(r.bytes for r in entries) > 32 << 20
    files = [f for f in table.documents().inputFiles() if "tenant=a" in f]
    assert len(files) > 8
    assert table.documents().count() == 65


def test_a_batch_of_a_stream_counts_once(spark, root):
    table = table_at(spark, root)
    table.upsert(frame(spark, [row("a", n, n) for n in range(50)]))
    events = frame(spark, [row("a", 1, 100, at=5, run=False)])
    first = table.apply(events, ("feed", 4))
    assert table.apply(events, ("feed", 4)).replayed and table.apply(events, ("feed", 3)).replayed
    assert table.snapshots.latest() == first.manifest_version
    assert not table.apply(events, ("other", 4)).replayed and not table.apply(events, ("feed", 5)).replayed
    assert table.snapshots.read().where("stream IS NOT NULL").count() == 2
    assert content(table)["a_t_1"] == 100 and table.counts().first().documents == 50


def test_vacuum_removes_old_reports(spark, root):
    from docloom.workspace import child_names

    table = table_at(spark, root)
    for n in range(3):
        table.upsert(frame(spark, [row("a", n, n)]))
    assert len(child_names(spark, f"{table.path}/reports/*")) == 3
    table.vacuum(older_than=0)
    assert child_names(spark, f"{table.path}/reports/*") == []


def test_a_conflict_that_never_ends_is_an_error(spark, root, monkeypatch):
    table = table_at(spark, root)
    table.upsert(frame(spark, [row("a", 1, 1)]))

    def always(*_args):
        raise Conflict("again")

    monkeypatch.setattr(store, "TRIES", 2)
    monkeypatch.setattr(table, "_publish", always)
    with pytest.raises(Conflict):
        table.upsert(frame(spark, [row("a", 2, 2)]))
    monkeypatch.undo()
    assert content(table) == {"a_t_1": 1}


def test_pages_are_sorted_once_a_version(spark, root):
    table = table_at(spark, root, target=50)
    table.upsert(frame(spark, [row("a", n, n * 37 % 400) for n in range(400)]))
    order = [F.col("v").desc(), F.col("doc_id").asc()]
    first = table.pages("by_v", order)
    assert [r.v for r in first.page(200, 210).collect()] == list(range(199, 189, -1))
    assert table.pages("by_v", order).number == first.number
    assert table.pages("by_v", [F.col("v").asc()]).number == first.number + 1
    table.upsert(frame(spark, [row("a", 1, 1000)]))
    later = table.pages("by_v", order)
    assert later.number == first.number + 2 and later.page(0, 1).first().v == 1000
    assert first.page(0, 1).first().v == 399
    table.vacuum(1, -1)
    assert later.page(0, 1).first().v == 1000
    assert table.pages("by_v", order).number == later.number
