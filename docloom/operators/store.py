"""The document table of one document type: versioned Parquet with upsert and delete.

Layout below the table's folder::

    data/version=<commit>/tenant=<t>/part=<commit>_<bucket>_<tenant hash>/*.parquet
    manifest/v=<n>/                      the parts that hold each (tenant, bucket)
    manifest-newest/                     numbers of the published manifests, for views
    quarantine/                          rows without a usable id
    reports/version=<commit>/            what a commit did for each tenant
    pages/<order>/                       a version in an order, for deep pages

A commit writes into a new ``version`` folder and then publishes a manifest that points at it.  A few
parts are read by their names, so that a small commit does not list a large table.  Otherwise reading
is a join of the data with the manifest on the partition columns; the name of a part is unique, so
dynamic partition pruning reads exactly the live folders.  Removing a tenant only edits the manifest.

A tenant gets as many buckets as its rows, or the bytes of its documents, call for, so one that
holds a third of all rows is spread over as many tasks as that takes, and a small one stays in one file.
A part that is too large for one task to sort is cut by ids into pieces, which are files of its folder.

Buckets form up to ``GROUPS`` groups per tenant.  Rows of a commit are appended to their group as a
delta part, and laid over the base when it is read, without shuffling the base.  Once the deltas of a group
have grown to a share of its base, or to many parts, the commit that brings the last of them folds this group
and no other.  Deltas of runs and of events are told apart, as a run's row beats what came before
it, and a later event counts only if it is newer than every event before.

A commit is made from one manifest and published on the newest one.  If others have published
meanwhile, only its own entries are changed; if they have replaced a part that it replaces too,
it merges again.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom import workspace
from docloom.operators.paging import PageDirectory
from docloom.operators.snapshots import SnapshotTable

#: Rows, and bytes of JSON, that a bucket is sized for.
TARGET_BUCKET_ROWS = 500_000
TARGET_BUCKET_BYTES = 512 * 1024 * 1024
#: Bytes of JSON that a file is sized for, where documents are large.
TARGET_FILE_BYTES = 256 * 1024 * 1024
#: Rows, and bytes of JSON, that a task of a commit sorts: larger parts are cut into pieces, each with files of its own.
PIECE_ROWS = 125_000
PIECE_BYTES = 32 * 1024 * 1024
#: Buckets are unions of these hash slices; a power of two, also the most buckets a tenant can have.
SLICES = 65_536
#: Most groups of buckets of a tenant, a power of two; each has deltas of its own.
GROUPS = 64
#: Up to this many tenants the layout of a commit is kept in the plan instead of a file.
FEW_TENANTS = 1_000
#: Deltas are folded into the base once they hold more than one row per this many base rows.
DELTA_SHARE = 20
#: Delta parts of a group are folded when there would be more than this many.
DELTA_PARTS = 32
#: Up to this many parts are read by name; more are found by joining with the manifest.
NAMED_PARTS = 1_000
#: Seconds for which a part that no manifest names may belong to a commit under way.
VACUUM_AGE = 24 * 3600.0
#: A tenant is spread anew once its buckets hold this many times the target.
GROWTH_FACTOR = 4
#: How often a commit merges again because others have replaced what it read.
TRIES = 10

#: Ages of rows in a merge: the base is older than all deltas, what arrives is newer.
BASE_AGE = 0
ARRIVING_AGE = 1 << 62

COMMON_COLUMNS = ("tenant", "document_type", "doc_id", "parent_key", "source")

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("tenant", T.StringType()),
        T.StructField("part", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("delta", T.BooleanType()),
        T.StructField("rows", T.LongType()),
        T.StructField("tombstones", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("digest", T.DecimalType(38, 0)),
        T.StructField("seq", T.LongType()),
        T.StructField("stream", T.StringType()),
        T.StructField("batch", T.LongType()),
    ]
)


class Conflict(Exception):
    """Another commit has replaced a part that this one replaces."""


@dataclass(frozen=True)
class CommitReport:
    """What one commit did: its version, the rows it took in and set aside, and the seconds it took.

    ``report`` is the folder of a table (tenant, records, failures) of all tenants; ``parts_written``
    counts base parts, delta parts not among them.  A batch of a stream that was committed before is
    ``replayed`` and changes nothing.
    """

    version: str
    rows_in: int
    rows_quarantined: int
    manifest_version: int
    seconds: float = 0.0
    report: str | None = None
    replayed: bool = False
    parts_written: int = 0


@dataclass(frozen=True)
class CommitPlan:
    """Sizes of a commit: rows per hash slice, layout per tenant, groups to fold, and totals.

    ``layout`` has (tenant, buckets, groups, respread, pieces, delta_pieces), the last two for a base part
    and a delta part; ``due`` has (tenant, group, due) for every group that rows arrive in or that must be
    folded.  ``parts`` counts the pieces to be written.
    """

    slices: DataFrame
    layout: DataFrame
    due: DataFrame
    tenants: int
    groups: int
    parts: int
    rows: int
    rows_bad: int
    bytes: int
    hot_slices: int


def slice_of(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(SLICES)).cast("int")


def piece_of(doc_id: Column, pieces: Column) -> Column:
    """Piece of a part that an id belongs to, by bits of its hash that the slice does not use."""
    return F.pmod(F.shiftrightunsigned(F.xxhash64(doc_id), 16), pieces).cast("int")


def pieces_for(rows: Column, size: Column, parts: Column) -> Column:
    """Pieces that each of some equal parts with these rows and bytes is cut into."""
    need = F.greatest(rows / F.lit(PIECE_ROWS), size / F.lit(PIECE_BYTES)) / parts
    return F.greatest(F.ceil(need), F.lit(1)).cast("int")


def row_digest() -> Column:
    """Digest of what a document says."""
    return F.xxhash64("doc_id", "parent_key", "source")


def digest_sum(digest: Column) -> Column:
    """Sum of digests, whatever their order."""
    return F.sum(digest.cast("decimal(38,0)")).cast("decimal(38,0)")


def width() -> Column:
    return F.coalesce(F.octet_length("source"), F.lit(0))


class DocumentTable:
    """Documents of one type for all tenants."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        document_type: str,
        fields: T.StructType,
        target_rows: int = TARGET_BUCKET_ROWS,
        target_bytes: int = TARGET_BUCKET_BYTES,
    ):
        self.spark = spark
        self.document_type = document_type
        self.path = f"{root.rstrip('/')}/{document_type}"
        self.fields = fields
        self.target_rows = target_rows
        self.target_bytes = target_bytes
        self.snapshots = SnapshotTable(spark, f"{self.path}/manifest", MANIFEST_SCHEMA, marked=True)
        self.row_schema = T.StructType(
            [
                T.StructField("doc_id", T.StringType()),
                T.StructField("parent_key", T.StringType()),
                T.StructField("source", T.StringType()),
                T.StructField("changed_at", T.LongType()),
                T.StructField("changed_seq", T.LongType()),
                T.StructField("deleted", T.BooleanType()),
                T.StructField("doc", fields),
            ]
        )
        self.file_schema = T.StructType(
            self.row_schema.fields
            + [
                T.StructField("from_run", T.BooleanType()),
                T.StructField("width", T.IntegerType()),
                T.StructField("digest", T.LongType()),
            ]
        )
        self._stored_schema = T.StructType(
            self.file_schema.fields
            + [T.StructField(name, T.StringType()) for name in ("version", "tenant", "part")]
        )

    # ---------------------------------------------------------------- reading

    def exists(self) -> bool:
        return workspace.path_exists(self.spark, self.snapshots.path)

    def create(self) -> bool:
        """Publish an empty table if there is none; True when one was created."""
        if self.exists():
            return False
        self.snapshots.write(workspace.local_frame(self.spark, [], MANIFEST_SCHEMA))
        return True

    def drop(self) -> bool:
        """Remove the table; True when it is gone."""
        return workspace.delete_path(self.spark, self.path)

    def manifest(self, version: int | None = None) -> DataFrame:
        """Entries of the parts in force, now or in a version."""
        return self._entries(self.snapshots.read(version))

    @staticmethod
    def _entries(snapshot: DataFrame) -> DataFrame:
        return snapshot.where("part IS NOT NULL")

    def _manifest_is_small(self) -> bool:
        path = self.snapshots.current_path()
        return path is None or (
            workspace.bytes_under(self.spark, path) <= workspace.BROADCAST_BYTE_LIMIT
        )

    def _scan(self, entries: DataFrame) -> DataFrame:
        """Stored rows of the given manifest entries."""
        data = f"{self.path}/data"
        # The comparison on ``rows`` also marks the side as selective, which is what
        # lets the planner prune the tenant and part folders.
        keys = entries.where(F.col("rows") > 0).select("tenant", "part")
        few = keys.take(NAMED_PARTS + 1)
        if not few:
            return workspace.local_frame(self.spark, [], self._stored_schema)
        reader = self.spark.read.schema(self._stored_schema).option("basePath", data)
        if len(few) <= NAMED_PARTS:
            return reader.parquet(*[f"{data}/{self._folder(row.tenant, row.part)}" for row in few])
        if self._manifest_is_small():
            keys = F.broadcast(keys)
        return reader.parquet(data).join(keys, ["tenant", "part"])

    def _folder(self, tenant: str, part: str) -> str:
        """Folder of a part below ``data``, as the partitioned writer names it."""
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        return f"version={part.split('_')[0]}/tenant={escape(tenant)}/part={part}"

    def rows(self, version: int | None = None) -> DataFrame:
        """Every row in force, tombstones included."""
        return self._rows(self.manifest(version))

    def _rows(self, manifest: DataFrame) -> DataFrame:
        base = self._scan(base_entries(manifest))
        pending = delta_rows(manifest)
        columns = ["tenant", *self.row_schema.names]
        return base.select(*columns) if pending == 0 else self._overlay(base, self._latest(manifest), pending)

    def _aged_scan(self, entries: DataFrame) -> DataFrame:
        """Stored rows with the age of their part: commits in order, the base before all."""
        ages = entries.select("part", F.when(F.col("delta"), F.col("seq")).otherwise(BASE_AGE).cast("bigint").alias("_age"))
        rows = self._scan(entries).select("tenant", "part", *self.row_schema.names, "from_run")
        return rows.join(workspace.broadcast_if_small(ages), "part").drop("part").transform(self._marked)

    def _latest(self, manifest: DataFrame) -> DataFrame:
        """Per id of the deltas: the last row of a run, and the event that wins after it.

        ``_run`` and ``_event`` are rows or null; ``_high`` is the highest event mark up to that run.
        """
        columns = self.row_schema.names
        rows = self._aged_scan(delta_entries(manifest))
        last = rows.groupBy("tenant", "doc_id").agg(F.max(F.when(F.col("from_run"), F.col("_age"))).alias("_run_age"))
        row = F.struct(*columns)
        before = F.col("_run_age").isNotNull() & (F.col("_age") <= F.col("_run_age"))
        is_run = F.col("from_run") & (F.col("_age") == F.col("_run_age"))
        order = F.struct("changed_at", "changed_seq", "deleted", "_age", "source")
        return (
            rows.join(last, ["tenant", "doc_id"])
            .groupBy("tenant", "doc_id")
            .agg(
                F.max_by(F.when(is_run, row), F.when(is_run, F.struct("deleted", "source"))).alias("_run"),
                F.max_by(F.when(~before, row), F.when(~before, order)).alias("_event"),
                F.max(F.when(before, F.col("_last"))).alias("_high"),
            )
        )

    def _overlay(self, base: DataFrame, deltas: DataFrame, pending: int) -> DataFrame:
        """Base rows that no delta replaces, and the rows that the deltas leave in force.

        The base meets only the keys of the deltas, so it is not shuffled while those can be
        broadcast.  A base row outlasts an event that is older than its own mark, and its mark counts
        for the events after a run; only base rows that an event has changed have one.
        """
        columns = ["tenant", *self.row_schema.names]
        same_id = ["tenant", "doc_id"]
        event = F.struct("_event.changed_at", "_event.changed_seq", "_event.deleted")
        keys = deltas.select(*same_id, event.alias("_delta"), F.col("_run").isNotNull().alias("_by_run"))
        keys = workspace.broadcast_if_small(keys, pending)
        mine = F.struct("changed_at", "changed_seq", "deleted")
        newer = ~F.col("_by_run") & F.col("changed_at").isNotNull() & (mine > F.col("_delta"))
        kept = base.join(keys, same_id, "left").where(F.col("_delta").isNull() | newer)
        marks = base.where("changed_at IS NOT NULL").join(keys.select(*same_id), same_id).select(*same_id, mine.alias("_mine"))
        found = deltas.join(marks, same_id, "left")
        outdated = F.col("_run").isNull() & (F.col("_mine") > event)
        high = F.greatest("_high", F.when(F.col("_mine").isNotNull(), F.struct("_mine.changed_at", "_mine.changed_seq")))
        run_mark = F.struct(high["changed_at"].alias("changed_at"), high["changed_seq"].alias("changed_seq"), F.col("_run.deleted").alias("deleted"))
        by_event = F.col("_event").isNotNull() & (F.col("_run").isNull() | high.isNull() | (event >= run_mark))
        chosen = found.where(~F.coalesce(outdated, F.lit(False))).withColumn("_high", high).select(
            "tenant", "_high", F.when(by_event, F.col("_event")).otherwise(F.col("_run")).alias("_row"), by_event.alias("_by_event")
        )
        row = chosen.select("tenant", "_row.*", "_high", "_by_event")
        for name in ("changed_at", "changed_seq"):
            row = row.withColumn(name, F.when(F.col("_by_event"), F.col(name)).otherwise(F.col(f"_high.{name}")))
        return kept.select(*columns).unionByName(row.select(*columns))

    def documents(self, version: int | None = None) -> DataFrame:
        """Live documents: common columns and the typed ``doc`` struct."""
        return (
            self.rows(version)
            .where(~F.col("deleted"))
            .select(
                "tenant",
                F.lit(self.document_type).alias("document_type"),
                "doc_id",
                "parent_key",
                "source",
                "doc",
            )
        )

    def typed(self, version: int | None = None) -> DataFrame:
        """Live documents with the declared fields as columns."""
        keys = [name for name in ("tenant", "doc_id", "parent_key") if name not in self.fields.names]
        return self.documents(version).select(*keys, "doc.*")

    def pages(self, name: str, order: Sequence[Column]) -> PageDirectory:
        """Live documents in an order, under a name; sorted once for each version of the table.

        Pages of the returned directory stay with the version it was made from.
        """
        version = self.snapshots.latest()
        mark = f"{version} {[str(column) for column in order]}"
        directory = PageDirectory(self.spark, f"{self.path}/pages/{name}", self.target_rows)
        return directory if directory.mark == mark else directory.build(self.typed(version), order, mark)

    def counts(self) -> DataFrame:
        """Live and deleted documents per tenant, from the manifest alone if it can tell."""
        manifest = self.manifest()
        if delta_rows(manifest) == 0:
            return manifest.groupBy("tenant").agg(
                F.sum(F.col("rows") - F.col("tombstones")).alias("documents"),
                F.sum("tombstones").alias("tombstones"),
            )
        return self.rows().groupBy("tenant").agg(
            F.count_if(~F.col("deleted")).alias("documents"),
            F.count_if("deleted").alias("tombstones"),
        )

    # ---------------------------------------------------------------- commits

    def replace(self, incoming: DataFrame, tenants: DataFrame) -> CommitReport:
        """Make ``incoming`` the whole content of ``tenants`` (one column ``tenant``).

        ``incoming`` is evaluated once and staged: buckets, rows and counts come from the same rows, even
        if the source moves on.  Buckets whose stored rows have the same digests stay as they are.  Of
        what other commits have published meanwhile, events stay in force.
        """
        started, first = time.time(), self.snapshots.latest()
        with workspace.Stage(self.spark) as stage:
            arriving = stage(self._arriving(incoming), f"incoming-{self.document_type}")
            for left in reversed(range(TRIES)):
                number = self.snapshots.latest()
                manifest = self._entries(self.snapshots.read(number))
                rows = arriving
                if number != first:
                    rows = stage(arriving.unionByName(self._events_since(first, manifest)), "overtaken")
                plan = self._plan(rows, manifest, stage, replacing=True)
                replaced = tenants.select("tenant").union(plan.layout.select("tenant")).distinct()
                own = manifest.join(workspace.broadcast_if_small(replaced), "tenant", "left_semi")
                same = stage(self._unchanged(own, plan), "unchanged")
                gone = own.join(workspace.broadcast_if_small(same.select("part")), "part", "left_anti")
                try:
                    return self._commit(rows, plan, number, stage(gone, "gone"), None, started, same)
                except Conflict:
                    if not left:
                        raise
        raise ValueError("no try is allowed")

    def upsert(self, incoming: DataFrame, batch: tuple[str, int] | None = None) -> CommitReport:
        """Merge rows by ``doc_id``; parts of other groups are neither read nor written.

        ``incoming`` has the row schema plus ``tenant`` and ``from_run``.  It is staged first:
        the groups and the merge must come from the same rows.  ``batch`` is a stream with the number
        of a batch; one that was committed before is recognised and left out.
        """
        started = time.time()
        with workspace.Stage(self.spark) as stage:
            arriving = stage(self._arriving(incoming), f"incoming-{self.document_type}")
            for left in reversed(range(TRIES)):
                number = self.snapshots.latest()
                snapshot = self.snapshots.read(number)
                if self._was_committed(snapshot, batch):
                    return CommitReport("", 0, 0, number, time.time() - started, replayed=True)
                manifest = self._entries(snapshot)
                plan = self._plan(arriving, manifest, stage)
                gone = stage(self._folded(manifest, plan), "gone")
                try:
                    return self._commit(arriving, plan, number, gone, gone, started, batch=batch)
                except Conflict:
                    if not left:
                        raise
        raise ValueError("no try is allowed")

    def apply(self, events: DataFrame, batch: tuple[str, int] | None = None) -> CommitReport:
        """Merge rows that stand for change events."""
        return self.upsert(events, batch)

    @staticmethod
    def _was_committed(snapshot: DataFrame, batch: tuple[str, int] | None) -> bool:
        if batch is None:
            return False
        done = snapshot.where((F.col("stream") == batch[0]) & (F.col("batch") >= batch[1]))
        return not done.isEmpty()

    def _arriving(self, rows: DataFrame) -> DataFrame:
        named = rows.select("tenant", *self.row_schema.names, "from_run")
        return self._marked(named.withColumn("_age", F.lit(ARRIVING_AGE).cast("bigint")))

    @staticmethod
    def _marked(rows: DataFrame) -> DataFrame:
        """Rows with the event mark that whichever row of their id wins will carry."""
        return rows.withColumn("_last", F.struct("changed_at", "changed_seq"))

    def _events_since(self, number: int, manifest: DataFrame) -> DataFrame:
        """Rows that events have changed since snapshot ``number``, as later than what arrives."""
        key = ["tenant", "doc_id", "changed_at", "changed_seq", "deleted"]
        before = self._rows(self._entries(self.snapshots.read(number))).where("changed_at IS NOT NULL")
        now = self._rows(manifest).where("changed_at IS NOT NULL").join(before.select(*key), key, "left_anti")
        named = now.select("tenant", *self.row_schema.names, F.lit(False).alias("from_run"))
        return self._marked(named.withColumn("_age", F.lit(ARRIVING_AGE + 1).cast("bigint")))

    def _commit(
        self,
        arriving: DataFrame,
        plan: CommitPlan,
        number: int,
        gone: DataFrame,
        folded: DataFrame | None,
        started: float,
        same: DataFrame | None = None,
        batch: tuple[str, int] | None = None,
    ) -> CommitReport:
        """Write what arrives, with the ``folded`` entries, and publish it in place of those ``gone``."""
        version = self._new_version()
        rows = self._unhot(arriving.where("doc_id IS NOT NULL"), plan)
        if folded is not None:
            rows = rows.unionByName(self._aged_scan(folded))
        seen = self._write(self._pick(rows, plan, version, same), plan, version)
        report = self._publish(plan, version, number, gone, seen, batch)
        if plan.rows_bad:
            self._quarantine(arriving, version)
        path = f"{self.path}/reports/version={version}"
        usable = F.when(F.col("slice").isNotNull(), F.col("rows")).otherwise(0)
        counts = plan.slices.groupBy("tenant").agg(
            F.sum(usable).alias("records"), F.sum(F.col("rows") - usable).alias("failures")
        )
        workspace.stage(counts.hint("rebalance"), "report", path)
        return CommitReport(
            version, plan.rows, plan.rows_bad, report[0], time.time() - started, path, parts_written=report[1]
        )

    def delete_ids(self, ids: DataFrame) -> CommitReport:
        """Remove documents by ``(tenant, doc_id)``; no tombstone outlasts the next fold."""
        gone = ids.select("tenant", "doc_id").distinct()
        return self.upsert(self.tombstones(gone, from_run=True))

    def delete_tenants(self, tenants: DataFrame) -> int:
        """Remove every document of the tenants: a change of the manifest only."""
        keys = workspace.broadcast_if_small(tenants.select("tenant").distinct())
        return self.snapshots.change(lambda now, _number: now.join(keys, "tenant", "left_anti"))

    def tombstones(self, ids: DataFrame, from_run: bool = False) -> DataFrame:
        """Delete rows for ``(tenant, doc_id [, changed_at, changed_seq])``."""
        when = [
            F.col(name) if name in ids.columns else F.lit(None).cast("bigint").alias(name)
            for name in ("changed_at", "changed_seq")
        ]
        return ids.select(
            "tenant",
            "doc_id",
            F.lit(None).cast("string").alias("parent_key"),
            F.lit(None).cast("string").alias("source"),
            *when,
            F.lit(True).alias("deleted"),
            F.lit(None).cast(self.fields).alias("doc"),
            F.lit(from_run).alias("from_run"),
        )

    def vacuum(self, keep: int = 1, older_than: float = VACUUM_AGE) -> int:
        """Drop the parts that the newest ``keep`` manifests no longer use, and old reports.

        Parts written less than ``older_than`` seconds ago stay, as a commit that is still being written
        has no manifest yet.  A commit's folder goes as a whole once no manifest names any of its parts;
        so the driver sees one row for each commit with live parts, and one for each dead part among those.
        """
        self.snapshots.prune(keep)
        before = time.time() - older_than
        used = workspace.local_frame(self.spark, [], "part string")
        for number in self.snapshots.versions():
            used = used.union(self._entries(self.snapshots.read(number)).select("part"))
        used = used.distinct()
        live = {row.version for row in used.select(F.split("part", "_")[0].alias("version")).distinct().toLocalIterator()}
        dropped, partly = 0, []
        for folder in workspace.child_names(self.spark, f"{self.path}/data/version=*"):
            if folder.endswith("/version=none"):
                continue  # the empty part that views read
            if folder.split("/version=")[-1] in live:
                partly.append(folder)
            elif workspace.modified_at(self.spark, folder) <= before:
                dropped += len(workspace.child_names(self.spark, f"{folder}/*/part=*"))
                workspace.delete_path(self.spark, folder)
        for folder in partly:
            parts = workspace.child_names(self.spark, f"{folder}/*/part=*")
            named = workspace.local_frame(self.spark, [(x, x.split("/part=")[-1]) for x in parts], "path string, part string")
            for row in named.join(used, "part", "left_anti").toLocalIterator():
                if workspace.modified_at(self.spark, row.path) <= before:
                    workspace.delete_path(self.spark, row.path)
                    dropped += 1
        for folder in workspace.child_names(self.spark, f"{self.path}/reports/version=*"):
            if workspace.modified_at(self.spark, folder) <= before:
                workspace.delete_path(self.spark, folder)
        for folder in workspace.child_names(self.spark, f"{self.path}/pages/*"):
            PageDirectory(self.spark, folder).vacuum(1, older_than)
        return dropped

    # ---------------------------------------------------------------- steps of a commit

    @staticmethod
    def _new_version() -> str:
        return f"c{uuid.uuid4().hex}"

    def _plan(
        self, incoming: DataFrame, manifest: DataFrame, stage: workspace.Stage, replacing: bool = False
    ) -> CommitPlan:
        """Count the incoming rows per tenant and hash slice, size the buckets, find the groups to fold.

        A null slice counts the rows without a usable id.
        """
        slice_no = F.when(F.col("doc_id").isNotNull(), slice_of(F.col("doc_id")))
        counted = (
            incoming.select("tenant", slice_no.alias("slice"), width().alias("width"), row_digest().alias("digest"))
            .groupBy("tenant", "slice")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("width").alias("bytes"), digest_sum(F.col("digest")).alias("digest"))
        )
        slices = stage(counted.hint("rebalance"), "slices")
        layout, tenants, totals = self._few(self._layout(slices, manifest, replacing), stage, "layout")
        names = ["tenant", "buckets", "groups", "respread", "pieces", "delta_pieces"]
        layout = layout.where("buckets IS NOT NULL").select(*names)
        sized = workspace.broadcast_if_small(layout, tenants)
        due = self._due(slices, sized, manifest, replacing)
        folded = F.col("pieces").cast("bigint") * (F.col("buckets") / F.col("groups")).cast("bigint")
        parts = F.when(F.col("due"), folded).otherwise(F.col("delta_pieces")).cast("bigint")
        counted = due.join(sized, "tenant").select("tenant", "group", "due", parts.alias("parts"))
        due, groups, written = self._few(counted, stage, "due")
        return CommitPlan(
            slices, layout, due.drop("parts"), tenants, groups, max(written["parts"] or 0, 1),
            totals["rows"], totals["bad"], totals["bytes"], totals["hot"],
        )

    def _few(self, df: DataFrame, stage: workspace.Stage, label: str) -> tuple[DataFrame, int, dict[str, int]]:
        """The rows kept in the plan or in a file, their number, and sums of the counting columns."""
        names = [name for name in ("rows", "bad", "bytes", "hot", "parts") if name in df.columns]
        few = df.take(FEW_TENANTS + 1)
        if len(few) <= FEW_TENANTS:
            return workspace.local_frame(self.spark, few, df.schema), len(few), {n: sum(r[n] for r in few) for n in names}
        kept = stage(df, label)
        row = kept.agg(F.count(F.lit(1)).alias("n"), *(F.sum(name).alias(name) for name in names)).first()
        return kept, row.n, {name: row[name] for name in names}

    def _layout(self, slices: DataFrame, manifest: DataFrame, replacing: bool) -> DataFrame:
        """Buckets and groups per incoming tenant, with its sizes; no buckets where no row has an id."""
        good = F.col("slice").isNotNull()
        arriving = slices.groupBy("tenant").agg(
            F.sum("rows").alias("rows"),
            F.sum(F.when(good, 0).otherwise(F.col("rows"))).alias("bad"),
            F.sum(F.when(good, F.col("bytes")).otherwise(0)).alias("bytes"),
            F.count_if(self._is_hot()).alias("hot"),
            F.count("slice").alias("_hit"),
        )
        stored = manifest.groupBy("tenant").agg(
            F.sum("rows").alias("_stored"),
            F.sum("bytes").alias("_stored_bytes"),
            F.max(F.when(~F.col("delta"), F.col("buckets"))).alias("_current"),
        )
        old, old_bytes = (F.lit(0) if replacing else F.coalesce(name, F.lit(0)) for name in ("_stored", "_stored_bytes"))
        need = F.greatest(
            F.ceil((F.col("rows") + old) / F.lit(self.target_rows)),
            F.ceil((F.col("bytes") + old_bytes) / F.lit(self.target_bytes)),
            F.lit(1),
        )
        wanted = F.least(F.pow(F.lit(2.0), F.ceil(F.log2(need))), F.lit(float(SLICES))).cast("int")
        fits = F.col("_current").isNotNull() & (wanted <= F.col("_current") * GROWTH_FACTOR)
        if replacing:
            fits &= F.col("_current") <= wanted * GROWTH_FACTOR
        buckets = F.when(F.col("_hit") > 0, F.when(fits, F.col("_current")).otherwise(wanted))
        groups = F.least(buckets, F.lit(GROUPS))
        return arriving.join(stored, "tenant", "left").select(
            "tenant",
            buckets.alias("buckets"),
            groups.alias("groups"),
            (F.col("_current").isNotNull() & ~fits).alias("respread"),
            pieces_for(F.col("rows") + old, F.col("bytes") + old_bytes, buckets).alias("pieces"),
            pieces_for(F.col("rows"), F.col("bytes"), groups).alias("delta_pieces"),
            "rows",
            "bad",
            "bytes",
            "hot",
        )

    def _due(self, slices: DataFrame, layout: DataFrame, manifest: DataFrame, replacing: bool) -> DataFrame:
        """(tenant, group, due) of the groups that rows arrive in, and of all groups of tenants spread anew.

        Deltas written under another number of groups make their tenant due as a whole.
        """
        hit = (
            slices.where("slice IS NOT NULL")
            .join(layout, "tenant")
            .groupBy("tenant", F.pmod("slice", "groups").cast("int").alias("group"))
            .agg(F.sum("rows").alias("_arriving"))
        )
        if replacing:
            return hit.select("tenant", "group", F.lit(True).alias("due"))
        known = manifest.join(layout.select("tenant", "groups", "respread"), "tenant")
        delta = F.col("delta")
        stored = known.groupBy("tenant", F.pmod("bucket", "groups").cast("int").alias("group")).agg(
            F.sum(F.when(~delta, F.col("rows"))).alias("_base"),
            F.coalesce(F.sum(F.when(delta, F.col("rows"))), F.lit(0)).alias("_pending"),
            F.count_if(delta).alias("_parts"),
        )
        whole = known.groupBy("tenant").agg(
            F.bool_or(F.col("respread") | (delta & (F.col("buckets") != F.col("groups")))).alias("_whole")
        )
        every = layout.join(whole.where("_whole"), "tenant").select(
            "tenant", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"), F.lit(True).alias("_all")
        )
        key = ["tenant", "group"]
        full = (F.col("_arriving") + F.col("_pending")) * DELTA_SHARE > F.coalesce("_base", F.lit(0))
        many = F.coalesce("_parts", F.lit(0)) >= DELTA_PARTS
        share = F.col("_base").isNull() | full | many
        return hit.join(stored, key, "left").join(every, key, "full").select(
            *key, F.coalesce("_all", share).alias("due")
        )

    def _folded(self, manifest: DataFrame, plan: CommitPlan) -> DataFrame:
        """Entries that the commit replaces: base and deltas of the groups that are due."""
        due = workspace.broadcast_if_small(plan.due.where("due"), plan.groups)
        layout = workspace.broadcast_if_small(plan.layout.select("tenant", "groups", "respread"), plan.tenants)
        placed = manifest.join(layout, "tenant").withColumn("group", F.pmod("bucket", "groups").cast("int"))
        return placed.join(due, ["tenant", "group"], "left_semi").select(*manifest.columns)

    def _unchanged(self, own: DataFrame, plan: CommitPlan) -> DataFrame:
        """Base entries whose bucket the arriving rows would write again as it is."""
        layout = workspace.broadcast_if_small(plan.layout, plan.tenants)
        arriving = (
            plan.slices.where("slice IS NOT NULL")
            .join(layout, "tenant")
            .groupBy("tenant", F.pmod("slice", "buckets").cast("int").alias("bucket"), "buckets")
            .agg(F.sum("rows").alias("rows"), digest_sum(F.col("digest")).alias("digest"))
        )
        pending = own.where("delta").select("tenant").distinct()
        still = own.where("NOT delta AND tombstones = 0").join(pending, "tenant", "left_anti")
        return still.join(arriving, ["tenant", "bucket", "buckets", "rows", "digest"], "left_semi")

    def _is_hot(self) -> Column:
        """A slice that alone overfills a bucket: some id in it must repeat very often."""
        return F.col("slice").isNotNull() & (F.col("rows") > self.target_rows)

    def _unhot(self, incoming: DataFrame, plan: CommitPlan) -> DataFrame:
        """Reduce ids that repeat so often that their slice alone overfills a bucket.

        An aggregate with a partial step keeps, per id, the row that wins and the highest event
        mark of all its rows, which is all that the final choice looks at; so copies of a hot id
        never meet in one task and the table is the same.  Slices of normal size pass through.
        """
        if plan.hot_slices == 0:
            return incoming
        hot = plan.slices.where(self._is_hot()).select("tenant", F.col("slice").alias("_slice"))
        hot = workspace.broadcast_if_small(hot, plan.hot_slices)
        sliced = incoming.withColumn("_slice", slice_of(F.col("doc_id")))
        order = F.struct("_age", "from_run", "changed_at", "changed_seq", "deleted", "source")
        reduced = (
            sliced.join(hot, ["tenant", "_slice"], "left_semi")
            .groupBy("tenant", "doc_id", "_age")
            .agg(F.max_by(F.struct(*sliced.columns), order).alias("_row"), F.max("_last").alias("_high"))
            .select("_row.*", "_high")
            .withColumn("_last", F.col("_high"))
            .drop("_high")
        )
        return sliced.join(hot, ["tenant", "_slice"], "left_anti").unionByName(reduced).drop("_slice")

    def _pick(self, rows: DataFrame, plan: CommitPlan, version: str, same: DataFrame | None = None) -> DataFrame:
        """One row per id, clustered by the part it is written to.

        Rows are shuffled once, by (tenant, part, piece); that placement also serves the per-id
        window, because an id lies in exactly one piece of a part, and its sort serves the writer.  So a
        task sorts a few pieces, whatever the size of a part.  Rows of buckets that stay the ``same`` are
        left out before.
        """
        bucket = F.pmod(slice_of(F.col("doc_id")), "buckets").cast("int")
        group = F.pmod(slice_of(F.col("doc_id")), "groups").cast("int")
        placed = rows.join(workspace.broadcast_if_small(plan.layout, plan.tenants), "tenant").withColumn("group", group)
        placed = placed.join(workspace.broadcast_if_small(plan.due, plan.groups), ["tenant", "group"])
        placed = placed.withColumn("bucket", bucket)
        if same is not None:
            kept = workspace.broadcast_if_small(same.select("tenant", "bucket"))
            placed = placed.join(kept, ["tenant", "bucket"], "left_anti")
        place = F.when(F.col("due"), F.col("bucket").cast("string")).otherwise(F.concat(F.lit("d"), F.col("group").cast("string")))
        part = F.concat_ws("_", F.lit(version), place, F.hex(F.xxhash64("tenant")))
        pieces = F.when(F.col("due"), F.col("pieces")).otherwise(F.col("delta_pieces"))
        placed = (
            placed.withColumns({"part": part, "_piece": piece_of(F.col("doc_id"), pieces)})
            .drop("buckets", "groups", "group", "bucket", "respread", "pieces", "delta_pieces")
            .repartition(2 * plan.parts, "tenant", "part", "_piece")
        )
        same_id = Window.partitionBy("tenant", "part", "_piece", "doc_id")
        run_age = F.max(F.when(F.col("from_run"), F.col("_age"))).over(same_id)
        with_run = placed.withColumn("_run_age", run_age)
        before = F.col("_run_age").isNotNull() & (F.col("_age") <= F.col("_run_age"))
        is_run = F.col("from_run") & (F.col("_age") == F.col("_run_age"))
        high = F.max(F.when(before, F.col("_last"))).over(same_id)
        known = with_run.withColumn("_high", high).withColumn("_mark", F.max("_last").over(same_id))
        mark = F.when(is_run, F.col("_high")).otherwise(F.struct("changed_at", "changed_seq"))
        order = [
            (is_run | ~before).desc(),
            F.struct(mark["changed_at"], mark["changed_seq"], "deleted", "_age").desc(),
            F.col("source").desc_nulls_last(),
        ]
        chosen = known.withColumn("_rank", F.row_number().over(same_id.orderBy(*order))).where("_rank = 1")
        # a delete of a run outlasts its delta only as the absence of a row
        chosen = chosen.where("NOT deleted OR NOT due OR (NOT from_run AND changed_at IS NOT NULL)")
        return chosen.select(
            "tenant",
            "part",
            "doc_id",
            "parent_key",
            "source",
            F.col("_mark.changed_at").alias("changed_at"),
            F.col("_mark.changed_seq").alias("changed_seq"),
            "deleted",
            "doc",
            (F.col("from_run") & ~F.col("due")).alias("from_run"),
            width().alias("width"),
            row_digest().alias("digest"),
        )

    def _write(self, rows: DataFrame, plan: CommitPlan, version: str) -> int:
        """Write the rows of a commit; returns how many the writer saw.

        Files of large documents get fewer of them, by the mean size of what arrives.
        """
        seen = Observation(f"written-{version}")
        writer = rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").partitionBy("tenant", "part")
        mean = plan.bytes / max(plan.rows, 1)
        if mean * self.target_rows > TARGET_FILE_BYTES:
            writer = writer.option("maxRecordsPerFile", max(1, int(TARGET_FILE_BYTES // mean)))
        writer.parquet(f"{self.path}/data/version={version}")
        return seen.get["rows"]

    def _publish(
        self, plan: CommitPlan, version: str, number: int, gone: DataFrame, rows: int, batch: tuple[str, int] | None
    ) -> tuple[int, int]:
        """Point the newest manifest at what was written, in place of the entries ``gone``.

        Returns the number of the manifest and that of the base parts written.  Fails if some of what
        was written is not there, and raises ``Conflict`` if entries to be replaced are gone already.
        """
        place = F.split("part", "_")[1]
        is_delta = place.startswith("d")
        layout = workspace.broadcast_if_small(plan.layout.select("tenant", "buckets", "groups"), plan.tenants)
        found = (
            self.spark.read.schema(self._stored_schema)
            .option("basePath", f"{self.path}/data")
            .parquet(f"{self.path}/data/version={version}")
            .groupBy("tenant", "part")
            .agg(
                F.count(F.lit(1)).alias("rows"),
                F.sum(F.col("deleted").cast("bigint")).alias("tombstones"),
                F.sum("width").alias("bytes"),
                digest_sum(F.col("digest")).alias("digest"),
            )
            .join(layout, "tenant")
            .select(
                "tenant",
                "part",
                F.when(is_delta, F.substring(place, 2, 10)).otherwise(place).cast("int").alias("bucket"),
                F.when(is_delta, F.col("groups")).otherwise(F.col("buckets")).alias("buckets"),
                is_delta.alias("delta"),
                "rows",
                "tombstones",
                "bytes",
                "digest",
            )
        )
        with workspace.Stage(self.spark) as stage:
            few = found.take(NAMED_PARTS + 1)
            if len(few) <= NAMED_PARTS:
                written = workspace.local_frame(self.spark, few, found.schema)
                total, bases = sum(row.rows for row in few), sum(not row.delta for row in few)
            else:
                written = stage(found, "written")
                total, bases = written.agg(F.sum("rows"), F.count_if(~F.col("delta"))).first()
            if total != rows:
                raise RuntimeError(f"{self.document_type}: {rows} rows were written and {total} are there")
            wanted = gone.select("part")

            def make(now: DataFrame, following: int) -> DataFrame:
                if following != number + 1:
                    self._check(now, wanted, written, batch)
                kept = now.join(workspace.broadcast_if_small(wanted), "part", "left_anti")
                fresh = written.withColumn("seq", F.lit(following).cast("bigint"))
                if batch is not None:
                    kept = kept.where(F.col("stream").isNull() | (F.col("stream") != batch[0]))
                    mark = workspace.local_frame(self.spark, [batch], "stream string, batch bigint")
                    fresh = fresh.unionByName(mark, allowMissingColumns=True)
                return kept.unionByName(fresh, allowMissingColumns=True)

            return self.snapshots.change(make), bases

    def _check(self, now: DataFrame, gone: DataFrame, written: DataFrame, batch: tuple[str, int] | None) -> None:
        """Raise ``Conflict`` unless what was ``written`` can take the place of ``gone`` in ``now``.

        Parts to be replaced must be there, and no other base part may hold rows of a bucket written.
        """
        if self._was_committed(now, batch):
            raise Conflict(f"{self.document_type}: batch {batch} is there")
        entries = self._entries(now)
        if not gone.join(entries.select("part"), "part", "left_anti").isEmpty():
            raise Conflict(f"{self.document_type}: parts were replaced meanwhile")
        others = base_entries(entries).join(gone, "part", "left_anti").select("tenant", "bucket", "buckets")
        mine = base_entries(written).select("tenant", "bucket", "buckets")
        sizes = mine.select("tenant", F.col("buckets").alias("_buckets")).distinct()
        clash = others.join(mine, ["tenant", "bucket", "buckets"], "left_semi").union(
            others.join(sizes, "tenant").where("buckets <> _buckets").select("tenant", "bucket", "buckets")
        )
        if not clash.isEmpty():
            raise Conflict(f"{self.document_type}: buckets were written meanwhile")

    def _quarantine(self, incoming: DataFrame, version: str) -> None:
        (
            incoming.where("doc_id IS NULL")
            .select("tenant", "source")
            .write.mode("errorifexists")
            .parquet(f"{self.path}/quarantine/version={version}")
        )

    def quarantined(self) -> DataFrame:
        """Rows set aside because they had no usable id."""
        schema = T.StructType(
            [
                T.StructField("tenant", T.StringType()),
                T.StructField("source", T.StringType()),
                T.StructField("version", T.StringType()),
            ]
        )
        if not workspace.path_exists(self.spark, f"{self.path}/quarantine"):
            return workspace.local_frame(self.spark, [], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/quarantine")


def base_entries(manifest: DataFrame) -> DataFrame:
    return manifest.where("NOT delta")


def delta_entries(manifest: DataFrame) -> DataFrame:
    return manifest.where("delta")


def delta_rows(manifest: DataFrame) -> int:
    """Rows of all deltas."""
    return manifest.agg(F.coalesce(F.sum(F.when(F.col("delta"), F.col("rows"))), F.lit(0))).first()[0]


def without(existing: DataFrame, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """Existing rows whose key is not among ``keys``."""
    return existing.join(keys.select(key), key, "left_anti")
