"""Views that follow a document table: their text finds the newest manifest whenever they are read.

A view is an object of the catalog, so every session of the application sees it, and with a shared metastore
other applications too.  Its text names folders only.  Reading lists, in this order, the numbers of
the published manifests, the manifests and the data: a manifest is complete before its number is written, and the
data before the manifest, so a commit published meanwhile is seen whole or not at all.

Deltas are laid over the base as in ``DocumentTable``: a base row counts as a run older than all
deltas.  The base is not shuffled for ids that no delta touches, unless the touched ids are too many
to be broadcast.  The parts of the newest manifest are found by pruning, if the manifests are small
enough to be broadcast (``spark.sql.autoBroadcastJoinThreshold``); else by a join.
"""

from __future__ import annotations

from docloom import workspace
from docloom.operators.store import COMMON_COLUMNS, DocumentTable

#: Folder below ``data`` of an empty part, which gives the columns while nothing is stored yet.
EMPTY_PART = "version=none/tenant=none/part=none"

_LIVE = """
WITH newest AS (SELECT max(CAST(value AS bigint)) AS v FROM text.`{path}/manifest-newest`),
entries AS (
  SELECT m.tenant, m.part, m.delta, m.seq FROM parquet.`{path}/manifest` m LEFT SEMI JOIN newest n ON m.v = n.v
  WHERE m.part IS NOT NULL AND m.rows > 0),
stored AS (
  SELECT e.tenant, d.doc_id, d.parent_key, d.source, d.changed_at, d.changed_seq, d.deleted, e.delta,
         d.from_run OR NOT e.delta AS by_run, IF(e.delta, e.seq, 0) AS age
  FROM entries e JOIN parquet.`{path}/data` d ON d.part = e.part),
touched AS (SELECT DISTINCT tenant, doc_id FROM stored WHERE delta),
meeting AS (
  SELECT * FROM stored WHERE delta
  UNION ALL
  SELECT s.* FROM stored s LEFT SEMI JOIN touched t ON s.tenant = t.tenant AND s.doc_id = t.doc_id WHERE NOT s.delta),
placed AS (
  SELECT *, struct(parent_key, source, changed_at, changed_seq, deleted) AS row,
         max(IF(by_run, age, NULL)) OVER (PARTITION BY tenant, doc_id) AS run_age
  FROM meeting),
merged AS (
  SELECT tenant, doc_id,
         max_by(row, struct(deleted, source)) FILTER (WHERE by_run AND age = run_age) AS run,
         max_by(row, struct(changed_at, changed_seq, deleted, age, source))
           FILTER (WHERE run_age IS NULL OR age > run_age) AS event,
         max(struct(changed_at, changed_seq)) FILTER (WHERE age <= run_age AND (delta OR changed_at IS NOT NULL)) AS high
  FROM placed GROUP BY tenant, doc_id),
chosen AS (
  SELECT tenant, doc_id,
         IF(event IS NOT NULL AND (run IS NULL OR high IS NULL
              OR struct(event.changed_at AS a, event.changed_seq AS s, event.deleted AS d)
                 >= struct(high.changed_at AS a, high.changed_seq AS s, run.deleted AS d)),
            event, run) AS row
  FROM merged)
SELECT s.tenant, '{kind}' AS document_type, s.doc_id, s.parent_key, s.source
FROM stored s LEFT ANTI JOIN touched t ON s.tenant = t.tenant AND s.doc_id = t.doc_id
WHERE NOT s.delta AND NOT s.deleted
UNION ALL
SELECT tenant, '{kind}', doc_id, row.parent_key, row.source FROM chosen WHERE NOT row.deleted"""


def quoted(text: str) -> str:
    """``text`` as an SQL string."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def live_sql(table: DocumentTable) -> str:
    """Query of the live documents of a table, common columns only, as of the time it is read."""
    return _LIVE.format(path=table.path.replace("`", "``"), kind=quoted(table.document_type)[1:-1])


def make_readable(table: DocumentTable) -> bool:
    """Give a table what its query needs beside its data; False if there is no table yet."""
    newest = table.snapshots.latest()
    if newest == 0:
        return False
    if not workspace.path_exists(table.spark, table.snapshots.mark_path(newest)):
        table.snapshots.mark(newest)
    empty = f"{table.path}/data/{EMPTY_PART}"
    if not workspace.path_exists(table.spark, f"{empty}/_SUCCESS"):
        workspace.local_frame(table.spark, [], table.file_schema).write.mode("overwrite").parquet(empty)
    return True


def documents_sql(tables: list[DocumentTable], tenant: str | None = None) -> str:
    """Query of the live documents of some tables, of one tenant if given."""
    parts = [f"SELECT * FROM ({live_sql(table)})" for table in tables]
    nothing = ", ".join(f"CAST(NULL AS string) AS {name}" for name in COMMON_COLUMNS)
    rows = " UNION ALL ".join(parts) if parts else f"SELECT {nothing} WHERE false"
    return f"SELECT * FROM ({rows})" + ("" if tenant is None else f" WHERE tenant = {quoted(tenant)}")
