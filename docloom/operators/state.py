"""Run state: status and high-water mark per tenant and document type."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom import model
from docloom.functions.scalars import equals_ignore_case
from docloom.operators.snapshots import SnapshotTable
from docloom.workspace import broadcast_if_small

STATE_KEY = ["tenant", "document_type"]

STATE_SCHEMA = T.StructType(
    [
        T.StructField("tenant", T.StringType()),
        T.StructField("appid", T.StringType()),
        T.StructField("document_type", T.StringType()),
        T.StructField("execution_started_at", T.LongType()),
        T.StructField("last_indexed_at", T.LongType()),
        T.StructField("last_index_type", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)


def has_status(status: str) -> Column:
    return equals_ignore_case(F.col("status"), F.lit(status))


def running(
    state: DataFrame,
    tenant: str | None = None,
    document_type: str | None = None,
    since: int | None = None,
) -> DataFrame:
    """State records that are running, of one tenant and type if given.

    With ``since`` only runs that started then or later count; an older one has died.
    """
    found = state.where(F.col("status") == model.RUNNING)
    if since is not None:
        found = found.where(F.coalesce("execution_started_at", F.lit(0)) >= since)
    return find(found, tenant, document_type)


def find(state: DataFrame, tenant: str | None = None, document_type: str | None = None) -> DataFrame:
    """State records by exact tenant and type."""
    if tenant is not None:
        state = state.where(F.col("tenant") == tenant)
    if document_type is not None:
        state = state.where(F.col("document_type") == document_type)
    return state


def unique_state(state: DataFrame) -> DataFrame:
    """Records whose (tenant, type) occurs exactly once."""
    once = state.groupBy(*STATE_KEY).agg(F.count(F.lit(1)).alias("_n")).where("_n = 1")
    return state.join(once.drop("_n"), STATE_KEY, "left_semi")


def completed(state: DataFrame) -> DataFrame:
    """Records that near-real-time indexing may build on: indexed once, and completed."""
    return state.where(F.col("last_index_type").isNotNull() & has_status(model.COMPLETED))


def tenant_eligibility(state: DataFrame) -> DataFrame:
    """Per tenant: is any type completed?"""
    done = F.col("last_index_type").isNotNull() & has_status(model.COMPLETED)
    return state.groupBy("tenant").agg(
        F.bool_or(F.coalesce(done, F.lit(False))).alias("eligible")
    )


def last_run(pairs: DataFrame, state: DataFrame) -> DataFrame:
    """Add ``last_run`` to (tenant, document_type) rows: 0 when never run or deleted."""
    marks = state.select(
        *STATE_KEY,
        F.when(has_status(model.DELETED), F.lit(0))
        .otherwise(F.col("last_indexed_at"))
        .cast("bigint")
        .alias("_mark"),
    )
    return pairs.join(marks, STATE_KEY, "left").withColumn(
        "last_run", F.coalesce("_mark", F.lit(0).cast("bigint"))
    ).drop("_mark")


def not_running(pairs: DataFrame, state: DataFrame, since: int | None = None) -> DataFrame:
    """(tenant, document_type) rows that no other run is working on."""
    return pairs.join(running(state, since=since).select(*STATE_KEY), STATE_KEY, "left_anti")


def with_app(state: DataFrame, tenants: DataFrame) -> DataFrame:
    """Fill ``appid`` from the tenant configuration."""
    apps = tenants.select("tenant", F.col("app_id").alias("_app"))
    return (
        state.join(broadcast_if_small(apps), "tenant", "left")
        .withColumn("appid", F.coalesce("_app", "appid") if "appid" in state.columns else F.col("_app"))
        .drop("_app")
    )


def upserted(state: DataFrame, updates: DataFrame) -> DataFrame:
    """State with ``updates`` in place of the records of the same key."""
    return state.join(updates.select(*STATE_KEY), STATE_KEY, "left_anti").unionByName(updates)


def status_inventory(
    tenants: DataFrame,
    types: Sequence[str],
    state: DataFrame,
    tenant: str | None = None,
    enabled: str = "any",
    status: str = "any",
) -> DataFrame:
    """Every tenant × type with its state; a missing state reads Not Run.

    ``types`` is the list of configured document types.  ``tenant`` limits
    to one tenant, ``enabled`` is true, false or any/all, ``status`` any/all or a status.
    """
    if tenant is not None:
        tenants = tenants.where(F.col("tenant") == tenant)
    if enabled.lower() not in ("any", "all"):
        tenants = tenants.where(F.col("enabled") == F.lit(enabled.lower() == "true"))
    # The configured types are a handful of names, so each tenant row lists them all.
    kinds = F.array(*[F.lit(kind) for kind in types])
    pairs = tenants.select("tenant", "enabled", F.explode(kinds).alias("document_type"))
    joined = pairs.join(state.drop("appid"), STATE_KEY, "left").withColumn(
        "status", F.coalesce("status", F.lit(model.NOT_RUN))
    )
    if status.lower() not in ("any", "all"):
        joined = joined.where(has_status(status))
    return joined


class RunState:
    """The stored state table."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = SnapshotTable(spark, path, STATE_SCHEMA)

    def read(self) -> DataFrame:
        return self.table.read()

    def update(self, updates: DataFrame) -> int:
        """Replace the records of the same (tenant, type)."""
        return self._change(lambda _now: updates.select(*STATE_SCHEMA.names))

    def _change(self, make: Callable[[DataFrame], DataFrame]) -> int:
        """Replace records by what ``make`` gives for the newest state; nobody writes in between."""
        return self.table.change(lambda now, _number: upserted(now, make(now)))

    def take(self, pairs: DataFrame, mode: str, run_ts: int, since: int | None = None) -> set[tuple[str, str]]:
        """Mark those (tenant, document_type, appid) rows as running that no other run is working on.

        Returns their (tenant, document_type): the pairs of a configuration, a few for each tenant.
        """
        taken: set[tuple[str, str]] = set()

        def make(now: DataFrame) -> DataFrame:
            free = not_running(pairs, now, since)
            taken.update((row.tenant, row.document_type) for row in free.select(*STATE_KEY).collect())
            return _changed(now, free, mode, model.RUNNING, started=run_ts)

        self._change(make)
        return taken

    def start(self, pairs: DataFrame, mode: str, run_ts: int) -> None:
        """Mark (tenant, document_type, appid) rows as running; the mark stays as it was."""
        self._change(lambda now: _changed(now, pairs, mode, model.RUNNING, started=run_ts))

    def finish(self, pairs: DataFrame, mode: str, run_ts: int) -> None:
        """Mark as completed, indexed up to the time taken before the read."""
        self._change(lambda now: _changed(now, pairs, mode, model.COMPLETED, started=run_ts, mark=run_ts))

    def touched(self, pairs: DataFrame, mode: str, status: str, run_ts: int) -> None:
        """Status and mode of a run that leaves the mark as it was."""
        self._change(lambda now: _changed(now, pairs, mode, status, started=run_ts))

    def fail(self, pairs: DataFrame, mode: str) -> None:
        """Mark as failed; the next run starts from the old mark."""
        self._change(lambda now: _changed(now, pairs, mode, model.FAILED))

    def deleted(self, pairs: DataFrame) -> None:
        """Mark as deleted: the next incremental run starts from the beginning."""
        self._change(lambda now: _changed(now, pairs, None, model.DELETED))


def _changed(
    state: DataFrame,
    pairs: DataFrame,
    mode: str | None,
    status: str,
    started: int | None = None,
    mark: int | None = None,
) -> DataFrame:
    """Records of ``pairs`` with a new status; what is not given stays as ``state`` has it.

    A deleted pair loses its mark with its status, so whatever becomes of the next run, one starts
    from the beginning.
    """
    kept = F.col("last_indexed_at")
    if status != model.DELETED:
        kept = F.when(~has_status(model.DELETED), kept)
    old = state.select(
        *STATE_KEY,
        F.col("appid").alias("_appid"),
        F.col("execution_started_at").alias("_started"),
        kept.alias("_mark"),
        F.col("last_index_type").alias("_mode"),
    )
    app = F.col("appid") if "appid" in pairs.columns else F.lit(None).cast("string")
    changed = pairs.select(*STATE_KEY, app.alias("appid")).join(old, STATE_KEY, "left")
    return changed.select(
        "tenant",
        F.coalesce("appid", "_appid").alias("appid"),
        "document_type",
        (F.col("_started") if started is None else F.lit(started).cast("bigint")).alias("execution_started_at"),
        (F.col("_mark") if mark is None else F.lit(mark).cast("bigint")).alias("last_indexed_at"),
        (F.col("_mode") if mode is None else F.lit(mode)).alias("last_index_type"),
        F.lit(status).alias("status"),
    )
