"""The four run modes."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom import model
from docloom.functions import keys
from docloom.model import IndexDef, IndexSet, Tenant
from docloom.operators import changes as ch
from docloom.operators import state as st
from docloom.operators.snapshots import SnapshotTable
from docloom.operators.store import TARGET_BUCKET_ROWS, VACUUM_AGE, CommitReport
from docloom.plans.catalog import DocumentIndex
from docloom.plans.documents import to_documents
from docloom.sources import tables
from docloom.sources.tables import union_tenants
from docloom.workspace import (
    Stage,
    broadcast_if_small,
    child_names,
    delete_path,
    local_frame,
    modified_at,
    stage,
)

CREATE_METHOD, DELETE_METHOD = "Create", "Delete"
SKIPPED = "Skipped"

#: Seconds after which a run that is still marked as running counts as dead.
STALE_AFTER = 24 * 3600

#: Document types whose Spark jobs may run at the same time.
PARALLEL_TYPES = 4


@dataclass(frozen=True)
class RunReport:
    """Outcome of one document type in one run.

    ``seconds`` is the time the commit took; ``batch_table`` reads the table ``batch_path`` of all tenants.
    """

    document_type: str
    mode: str
    status: str
    tenants: int
    rows_in: int = 0
    rows_quarantined: int = 0
    skipped: tuple[str, ...] = ()
    error: str | None = None
    seconds: float = 0.0
    batch_path: str | None = None
    batch_size: int = 1

    def batch_table(self, spark: SparkSession) -> DataFrame:
        """What the run did for each tenant, a row for every one; none without a commit.

        ``took_ms`` is the time of the commit, which all its tenants share, and ``ms_per_document`` that for
        each of their documents.
        """
        schema = "tenant string, records bigint, failures bigint"
        rows = spark.read.schema(schema).parquet(self.batch_path) if self.batch_path else local_frame(spark, [], schema)
        return rows.select(
            "tenant",
            F.lit(self.document_type).alias("document_type"),
            "records",
            F.lit(self.batch_size).cast("long").alias("batch_size"),
            F.ceil(F.col("records") / self.batch_size).alias("total_batches"),
            "failures",
            F.lit(1000.0 * self.seconds).alias("took_ms"),
            F.lit(1000.0 * self.seconds / max(self.rows_in - self.rows_quarantined, 1)).alias("ms_per_document"),
        )


@dataclass(frozen=True)
class TypeJob:
    """One document type of a run, ready to be written."""

    index: IndexDef
    tenants: tuple[Tenant, ...]
    skipped: tuple[str, ...]
    documents: DataFrame | None = None
    error: str | None = None


def is_delete_method(method: str) -> bool:
    """Whether a selective run deletes; methods are named in any case, and no others are allowed."""
    known = {CREATE_METHOD.lower(): False, DELETE_METHOD.lower(): True}
    if method.lower() not in known:
        raise ValueError(f"method {method!r} is neither {CREATE_METHOD} nor {DELETE_METHOD}")
    return known[method.lower()]


class Indexer:
    """Runs index definitions for tenants and keeps documents and run state.

    ``source`` has ``rows(index, tenants) -> DataFrame`` with a ``tenant`` column.  One
    Spark plan serves all tenants of a type; the loop over types follows the
    configuration, not the data.
    """

    def __init__(
        self,
        spark: SparkSession,
        index_set: IndexSet,
        tenants: Sequence[Tenant],
        source,
        root: str,
        target_rows: int = TARGET_BUCKET_ROWS,
        stale_after: int = STALE_AFTER,
    ):
        self.spark = spark
        self.stale_after = stale_after
        self.index_set = index_set
        self.source = source
        self.root = root.rstrip("/")
        self.index = DocumentIndex(spark, index_set, root, target_rows)
        self.state = st.RunState(spark, self._side_path("state"))
        seen: dict[str, Tenant] = {}
        self.duplicate_tenants: list[Tenant] = []
        for tenant in tenants:
            if tenant.id in seen:
                self.duplicate_tenants.append(tenant)
            else:
                seen[tenant.id] = tenant
        self.tenants = list(seen.values())

    # ---------------------------------------------------------------- run modes

    def full(
        self, types: str | None = None, tenant: str | None = None, run_ts: int | None = None
    ) -> list[RunReport]:
        """Replace the documents of the tenants and types by what the source has now."""
        return self._run(model.FULL, types, tenant, run_ts)

    def incremental(
        self, types: str | None = None, tenant: str | None = None, run_ts: int | None = None
    ) -> list[RunReport]:
        """Upsert the rows modified at or after each tenant's last completed run."""
        return self._run(model.INCREMENTAL, types, tenant, run_ts)

    def selective(
        self, tenant: str, document_type: str, ids: Sequence[int] | DataFrame, method: str = CREATE_METHOD
    ) -> CommitReport | None:
        """Upsert, or delete, the given ids of one tenant and type.

        Returns ``None`` when the tenant is unknown or switched off.  The state of the pair gets
        status and mode, also when the run fails; its mark stays, as other rows may have changed.
        """
        deleting = is_delete_method(method)
        started = int(time.time())
        chosen = self._enabled(tenant)
        if not chosen:
            return None
        index = self.index_set.find(document_type)
        table = self.index.table(index.document_type)
        pairs = self._pairs(index, chosen)
        try:
            if deleting:
                report = table.delete_ids(self._document_keys(tenant, index, ids))
            else:
                rows = tables.with_ids(self.source.rows(index, chosen), index.id_column, ids)
                report = table.upsert(to_documents(rows, index))
        except Exception:
            self.state.touched(pairs, model.SELECTIVE, model.FAILED, started)
            raise
        self.state.touched(pairs, model.SELECTIVE, model.COMPLETED, started)
        self.index.create_tenant_aliases([tenant])
        return report

    def near_realtime(
        self,
        changes: DataFrame,
        refresh_views: bool = True,
        batch_id: int | None = None,
        stream: str | None = None,
    ) -> DataFrame:
        """Apply pending changes; returns the rows taken off the log.

        Rows of tenants without any completed type are left for later.  Rows that cannot
        be understood go to the quarantine table and do not stop the others; a batch that is
        replayed under its number replaces what it put there.  With the name of a ``stream`` each table
        remembers the last batch, and leaves out one that it has.  The batch
        as it was read stays below the index as a record of what was applied.
        """
        named = changes.select(
            *[F.col(field.name).cast(field.dataType) for field in ch.CHANGE_SCHEMA.fields],
            *(["message"] if "message" in changes.columns else []),
        )
        batch = stage(ch.classify(named), "changes", f"{self._side_path('changes')}/{uuid.uuid4().hex}")
        usable, problems = ch.split_problems(batch)
        if not problems.isEmpty():
            number = uuid.uuid4().hex if batch_id is None else batch_id
            problems.write.mode("overwrite").parquet(f"{self._side_path('bad_changes')}/batch={number}")
        state = self.state.read()
        with Stage(self.spark) as scratch:
            ready = ch.eligible_changes(usable, st.completed(state))
            flags = scratch(ch.bulk_flags(ready), "flags")
            items, bulk_deleted, removed = ch.override_bulk(ready, flags)
            items = scratch(ch.latest_change(items), "items")
            pending = {row.document_type for row in items.select("document_type").distinct().collect()}
            for index in self.index_set.indexes:
                if index.document_type.lower() in pending:
                    self.apply_items(index, items, None if stream is None or batch_id is None else (stream, batch_id))
            self._delete_marked(bulk_deleted, removed)
            touched = {row.tenant for row in flags.select("tenant").distinct().collect()}
        if refresh_views:
            self.index.create_tenant_aliases([one.id for one in self._enabled(None) if one.id in touched])
        eligible = st.tenant_eligibility(state).where("eligible").select("tenant")
        taken = usable.join(broadcast_if_small(eligible), "tenant", "left_semi")
        names = ch.CHANGE_SCHEMA.names
        return taken.select(*names).unionByName(problems.select(*names))

    def poll(self, log: SnapshotTable) -> int:
        """Apply a stored change log once; returns the number of rows taken off it.

        The rows leave the log only after they were applied, and only if the index set
        says so; otherwise they are applied again by the next poll, to the same effect.
        """
        pending = log.read()
        taken = self.near_realtime(pending)
        count = taken.count()
        if count and self.index_set.delete_records_after_indexing:
            # from the log as it is now: what arrived meanwhile stays
            log.change(lambda now, _number: ch.purge(now, taken))
        return count

    def vacuum(self, keep: int = 1, older_than: float = VACUUM_AGE) -> int:
        """Remove what only older versions use, and the record of changes applied before then.

        Readers of the newest ``keep`` versions are safe.
        """
        self.state.table.prune(keep)
        for folder in child_names(self.spark, f"{self._side_path('changes')}/*"):
            if modified_at(self.spark, folder) <= time.time() - older_than:
                delete_path(self.spark, folder)
        return sum(self.index.table(kind).vacuum(keep, older_than) for kind in self.index_set.types())

    def delete(self, types: str | None = None, tenant: str | None = None) -> None:
        """Delete all documents of the tenants and types, and mark them as deleted."""
        chosen = [t for t in self.tenants if tenant is None or t.id == tenant]
        ids = self._tenant_frame(chosen)
        for index in self.index_set.select(types):
            self.index.table(index.document_type).delete_tenants(ids)
            self.state.deleted(self._pairs(index, chosen))

    # ---------------------------------------------------------------- full and incremental

    def _run(
        self, mode: str, types: str | None, tenant: str | None, run_ts: int | None
    ) -> list[RunReport]:
        # Taken before anything is read, so rows changed meanwhile are seen again.
        started = int(time.time()) if run_ts is None else run_ts
        enabled = self._enabled(tenant)
        self.index.create()
        indexes = list(self.index_set.select(types))
        # taken in one step, so of two runs that start together only one gets a pair
        pairs = union_tenants([self._pairs(index, enabled) for index in indexes]) if indexes and enabled else None
        since = int(time.time()) - self.stale_after
        free = set() if pairs is None else self.state.take(pairs, mode, started, since)
        jobs = [self._job(mode, index, enabled, free) for index in indexes]
        due = [job for job in jobs if job.tenants]
        # Types write to tables of their own, so their Spark jobs may overlap.
        names = [one.id for one in enabled]
        with ThreadPoolExecutor(max_workers=PARALLEL_TYPES + 1) as pool:
            made = pool.submit(self.index.create_tenant_aliases, names)
            futures = {id(job): pool.submit(self._run_type, mode, job, started) for job in due}
        made.result()
        # views follow their tables; only a table that this run has created asks for new ones
        self.index.create_tenant_aliases(names)
        return [
            futures[id(job)].result() if id(job) in futures
            else RunReport(job.index.document_type, mode, SKIPPED, 0, skipped=job.skipped)
            for job in jobs
        ]

    def _job(
        self, mode: str, index: IndexDef, enabled: list[Tenant], taken: set[tuple[str, str]]
    ) -> TypeJob:
        """The tenants of a type that this run has taken, and their rows to index."""
        free = [tenant for tenant in enabled if (tenant.id, index.document_type) in taken]
        skipped = tuple(tenant.id for tenant in enabled if tenant not in free)
        if not free:
            return TypeJob(index, (), skipped)
        self.index.table(index.document_type)
        try:
            marks = None
            if mode == model.INCREMENTAL:
                known = st.last_run(self._pairs(index, free), self.state.read())
                marks = {row.tenant: row.last_run for row in known.collect()}
            rows = self.source.rows(index, free, marks)
            return TypeJob(index, tuple(free), skipped, to_documents(rows, index))
        except Exception as error:
            return TypeJob(index, tuple(free), skipped, error=str(error))

    def _run_type(self, mode: str, job: TypeJob, started: int) -> RunReport:
        kind = job.index.document_type
        pairs = self._pairs(job.index, job.tenants)
        report = RunReport(kind, mode, model.FAILED, len(job.tenants), skipped=job.skipped, error=job.error)
        if job.error is None:
            try:
                table = self.index.table(kind)
                if mode == model.FULL:
                    commit = table.replace(job.documents, self._tenant_frame(job.tenants))
                else:
                    commit = table.upsert(job.documents)
                report = replace(
                    report,
                    status=model.COMPLETED,
                    rows_in=commit.rows_in,
                    rows_quarantined=commit.rows_quarantined,
                    seconds=commit.seconds,
                    batch_path=commit.report,
                    batch_size=self.index_set.effective_batch_count(),
                )
            except Exception as error:
                report = replace(report, error=str(error))
        if report.status == model.COMPLETED:
            self.state.finish(pairs, mode, started)
        else:
            self.state.fail(pairs, mode)
        return report

    # ---------------------------------------------------------------- near-real-time

    def apply_items(
        self, index: IndexDef, items: DataFrame, batch: tuple[str, int] | None = None
    ) -> CommitReport:
        """Apply the latest change per item to one document type, once for each ``batch`` of a stream."""
        enabled = self._enabled(None)
        mine = items.where(F.col("document_type") == index.document_type.lower())
        mine = tables.filter_tenants(mine, enabled)
        updates, deletes = ch.split_update_delete(mine)
        table = self.index.table(index.document_type)
        gone = table.tombstones(
            deletes.select(
                "tenant",
                keys.doc_id(F.col("tenant"), index.document_type, F.col("object_id")).alias("doc_id"),
                F.col("event_time").alias("changed_at"),
                F.col("seq").alias("changed_seq"),
            )
        )
        changed = {row.tenant for row in updates.select("tenant").distinct().collect()}
        if not changed:
            return table.apply(gone, batch)
        rows = self._rows_of(index, updates, [tenant for tenant in enabled if tenant.id in changed])
        return table.apply(to_documents(rows, index).unionByName(gone), batch)

    def _rows_of(self, index: IndexDef, updates: DataFrame, tenants: list[Tenant]) -> DataFrame:
        """Source rows of the changed ids with the event that asked for them.

        Ids the source no longer returns drop out, and their documents stay.
        """
        rows = self.source.rows(index, tenants)
        id_column = keys.find_column(rows, index.id_column)
        if id_column is None:
            raise ValueError(f"id column {index.id_column!r} is not in the query result")
        wanted = updates.select(
            F.col("tenant").alias("_tenant"),
            F.col("object_id").alias("_id"),
            F.col("event_time").alias("_changed_at"),
            F.col("seq").alias("_changed_seq"),
        )
        ids = wanted.select("_id").where("_id IS NOT NULL").distinct()
        few = [row._id for row in ids.take(tables.IN_LIST_LIMIT + 1)]
        if len(few) <= tables.IN_LIST_LIMIT:
            rows = rows.where(tables.id_value(rows, id_column).isin(few))
        else:
            rows, _ = tables.id_bound(rows, id_column, ids)
        same = (F.col("tenant") == F.col("_tenant")) & (
            F.col(id_column).try_cast("bigint") == F.col("_id")
        )
        return rows.join(broadcast_if_small(wanted), same).drop("_tenant", "_id")

    def _delete_marked(self, bulk_deleted: DataFrame, removed: DataFrame) -> None:
        marked = bulk_deleted.select("tenant", "document_type").unionByName(
            removed.select("tenant", F.explode(F.array(*[
                F.lit(kind.lower()) for kind in self.index_set.types()
            ])).alias("document_type"))
        )
        touched = {row.document_type for row in marked.select("document_type").distinct().collect()}
        for index in self.index_set.indexes:
            if index.document_type.lower() in touched:
                tenants = marked.where(F.col("document_type") == index.document_type.lower())
                self.index.table(index.document_type).delete_tenants(tenants)
                self.state.deleted(
                    tenants.select("tenant").withColumn("document_type", F.lit(index.document_type))
                )

    def _side_path(self, name: str) -> str:
        return f"{self.root}/{self.index_set.parent_index}_{name}"

    def bad_changes(self) -> DataFrame:
        """Changes set aside so far."""
        return self.spark.read.option("mergeSchema", "true").parquet(self._side_path("bad_changes"))

    # ---------------------------------------------------------------- small frames

    def _enabled(self, tenant: str | None) -> list[Tenant]:
        return [t for t in self.tenants if t.enabled and (tenant is None or t.id == tenant)]

    def _tenant_frame(self, tenants: Sequence[Tenant]) -> DataFrame:
        return local_frame(self.spark, [(t.id,) for t in tenants], "tenant string")

    def _pairs(self, index: IndexDef, tenants: Sequence[Tenant]) -> DataFrame:
        rows = [(t.id, index.document_type, t.app_id) for t in tenants]
        return local_frame(self.spark, rows, "tenant string, document_type string, appid string")

    def _document_keys(self, tenant: str, index: IndexDef, ids: Sequence[int] | DataFrame) -> DataFrame:
        frame = ids if isinstance(ids, DataFrame) else local_frame(self.spark, 
            [(int(value),) for value in ids], "id bigint"
        )
        frame = frame.toDF("id").withColumn("tenant", F.lit(tenant))
        return frame.select(
            "tenant", keys.doc_id(F.col("tenant"), index.document_type, F.col("id")).alias("doc_id")
        )
