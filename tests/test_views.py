"""Views of stored documents follow the tables they read."""

import random

import pytest

from docloom import Indexer, IndexSet
from docloom.operators import store
from docloom.plans import views
from docloom.sources import SharedTables
from docloom.workspace import child_names, local_frame
from tests.test_runs import ITEM, NOTE, TENANTS, put_items, put_notes
from tests.test_store import content, frame, row, table_at


def of_view(session, name):
    return {r.doc_id: r.source for r in session.sql(f"SELECT doc_id, source FROM `{name}`").collect()}


def of_table(table):
    return {r.doc_id: r.source for r in table.documents().collect()}


def test_another_session_sees_a_later_run(spark, root):
    put_items(spark, [("a", 1, "x", 10), ("b", 2, "y", 20)])
    put_notes(spark, [("a", 1)])
    jobs = Indexer(spark, IndexSet((ITEM, NOTE)), TENANTS, SharedTables(spark), root)
    jobs.full(run_ts=100)
    other = spark.newSession()
    assert set(of_view(other, "a")) == {"a_item_1", "a_note_1"}
    put_items(spark, [("a", 3, "z", 200), ("a", 1, "xx", 200)])
    # straight to the table: no run makes a view anew
    jobs.index.table("item").upsert(
        local_frame(spark, [("a", "a_item_9", None, "{}", None, None, False, None, True)],
                    "tenant string, doc_id string, parent_key string, source string, changed_at bigint, "
                    "changed_seq bigint, deleted boolean, doc struct<id:bigint,v:string>, from_run boolean"))
    assert set(of_view(other, "a")) == {"a_item_1", "a_item_9", "a_note_1"}
    jobs.incremental(run_ts=300)
    seen = of_view(other, "a")
    assert set(seen) == {"a_item_1", "a_item_3", "a_item_9", "a_note_1"} and '"xx"' in seen["a_item_1"]
    jobs.index.create_alias("all of them")
    assert set(of_view(other, "b")) == {"b_item_2"}
    assert set(of_view(spark, "all of them")) == {r.doc_id for r in jobs.index.documents().collect()}
    assert jobs.index.drop_alias("a") and not jobs.index.drop_alias("a")


def test_a_view_is_made_once(spark, root, monkeypatch):
    put_items(spark, [("a", 1, "x", 10)])
    jobs = Indexer(spark, IndexSet((ITEM,)), TENANTS, SharedTables(spark), root)
    jobs.full(run_ts=100)
    asked = []
    run = spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: asked.append(text) or run(text, *a, **k))
    jobs.full(run_ts=200)
    assert not [text for text in asked if text.startswith("CREATE")]


@pytest.mark.parametrize("seed, parts, share", [(1, 32, 1), (2, 3, 3)])
def test_a_view_lays_deltas_over_the_base_as_the_table_does(spark, root, monkeypatch, seed, parts, share):
    monkeypatch.setattr(store, "DELTA_PARTS", parts)
    monkeypatch.setattr(store, "DELTA_SHARE", share)
    rng = random.Random(seed)
    table = table_at(spark, root, target=40)
    table.create()
    assert views.make_readable(table)
    name = f"follows_{seed}"
    spark.sql(f"CREATE OR REPLACE VIEW `{name}` AS {views.documents_sql([table])}")
    assert of_view(spark, name) == {}
    table.upsert(frame(spark, [row("a", n, n) for n in range(60)] + [row("007", 1, 1)]))
    for seq in range(8):
        run = rng.random() < 0.4
        numbers = rng.sample(range(8), rng.randrange(1, 4))
        one = []
        for k, n in enumerate(numbers):
            gone = not run and rng.random() < 0.3
            at, place = (None, None) if run else (rng.randrange(30), 10 * seq + k)
            one.append(row("a", n, 1000 * seq + n, at=at, seq=place, deleted=gone, run=run))
        (table.upsert if run else table.apply)(frame(spark, one))
        if seq % 2:
            assert of_view(spark, name) == of_table(table)
    table.delete_ids(local_frame(spark, [("a", "a_t_20")], "tenant string, doc_id string"))
    assert of_view(spark, name) == of_table(table) and "007_t_1" in of_view(spark, name)
    rows = spark.sql(f"SELECT tenant FROM `{name}` WHERE tenant = '007'").collect()
    assert [r.tenant for r in rows] == ["007"]
    table.vacuum(1, 0)
    assert of_view(spark, name) == of_table(table)
    assert len(child_names(spark, f"{table.path}/manifest-newest/*")) == 1
    table.delete_tenants(local_frame(spark, [("a",), ("007",)], "tenant string"))
    assert of_view(spark, name) == content(table) == {}


def test_a_view_reads_live_parts_only(spark, root):
    table = table_at(spark, root, target=40)
    for value in range(3):
        table.replace(frame(spark, [row("a", n, n + value) for n in range(200)]), local_frame(spark, [("a",)], "tenant string"))
    views.make_readable(table)
    plan = spark.sql(views.documents_sql([table], "a"))._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan.lower()
