"""Small metadata tables kept as numbered, immutable snapshots.

A snapshot counts once its success marker exists, so a reader never sees half a write
and a job that dies leaves the previous snapshot in force.  A writer claims the next number with a file
that only one can create, so every snapshot is made from the one before it and no
writer overwrites what another has published.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from docloom import workspace

#: Seconds after which a claimed number without a snapshot counts as that of a dead writer.
CLAIM_AGE = 900.0
#: Seconds between two looks at a number that another writer has claimed.
POLL = 0.2

#: Local file systems check and create a file in two steps.
_claiming = threading.Lock()


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, marked: bool = False):
        """``marked`` snapshots have their numbers written beside the table, for readers that can only read files."""
        self.spark = spark
        self.path = path
        self.schema = schema
        self.marked = marked

    def versions(self) -> list[int]:
        """Published snapshot numbers, oldest first."""
        markers = workspace.child_names(self.spark, f"{self.path}/v=*/_SUCCESS")
        return sorted(int(marker.split("/v=")[-1].split("/")[0]) for marker in markers)

    def version_path(self, version: int) -> str:
        return f"{self.path}/v={version:010d}"

    def current_path(self) -> str | None:
        versions = self.versions()
        return self.version_path(versions[-1]) if versions else None

    def latest(self) -> int:
        """Number of the newest snapshot; 0 before the first."""
        versions = self.versions()
        return versions[-1] if versions else 0

    def read(self, version: int | None = None) -> DataFrame:
        """The newest snapshot, or the one of a number; no rows before the first."""
        version = self.latest() if version is None else version
        if version == 0:
            return workspace.local_frame(self.spark, [], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.version_path(version))

    def write(self, df: DataFrame) -> int:
        """Publish the next snapshot, whatever the one before holds."""
        return self.change(lambda _now, _number: df)

    def change(self, make: Callable[[DataFrame, int], DataFrame]) -> int:
        """Publish ``make(newest snapshot, number of the new one)``; returns the number.

        Nobody publishes between the reading and the writing.  An error in ``make`` or the write leaves
        the newest snapshot in force and gives the number up.
        """
        base, number = self._claimed()
        try:
            df = make(self.read(base), number)
            columns = [df[field.name].cast(field.dataType) for field in self.schema.fields]
            # The rows are spread by their size, so a small snapshot is one file.
            df.select(*columns).hint("rebalance").write.mode("errorifexists").parquet(self.version_path(number))
        finally:
            workspace.delete_path(self.spark, self._claim_path(number))
        if self.latest() != number:
            raise RuntimeError(f"{self.path}: snapshot {number} came after others took its writer for dead")
        if self.marked:
            self.mark(number)
        return number

    def mark_path(self, number: int) -> str:
        return f"{self.path}-newest/{number:010d}"

    def mark(self, number: int) -> None:
        """Write down that a snapshot is published."""
        workspace.write_text(self.spark, self.mark_path(number), str(number))

    def _claim_path(self, number: int) -> str:
        # hidden from readers of the whole folder
        return f"{self.path}/_claim-{number:010d}"

    def _claimed(self) -> tuple[int, int]:
        """The newest number and the next one, which is ours alone from now on."""
        while True:
            base = self.latest()
            claims = workspace.child_names(self.spark, f"{self.path}/_claim-*")
            open_ = {int(claim.split("/_claim-")[-1]): claim for claim in claims}
            alive = [n for n, claim in open_.items() if n > base and self._is_young(claim)]
            if alive:
                time.sleep(POLL)
                continue
            number = self._next_version(max(open_, default=0))
            with _claiming:
                fs, target = workspace.file_system(self.spark, self._claim_path(number))
                ours = fs.createNewFile(target)
            # a writer that was faster has published meanwhile
            if ours and self.latest() == base:
                return base, number
            if ours:
                workspace.delete_path(self.spark, self._claim_path(number))

    def _is_young(self, claim: str) -> bool:
        fs, target = workspace.file_system(self.spark, claim)
        return fs.exists(target) and time.time() - fs.getFileStatus(target).getModificationTime() / 1000.0 < CLAIM_AGE

    def _next_version(self, claimed: int = 0) -> int:
        """One past every folder and claim there is, so a write that died is never reused."""
        folders = workspace.child_names(self.spark, f"{self.path}/v=*")
        return max([claimed, *(int(folder.split("/v=")[-1]) for folder in folders)]) + 1

    def prune(self, keep: int = 1) -> None:
        """Remove all but the newest snapshots."""
        for version in self.versions()[: -max(keep, 1)]:
            workspace.delete_path(self.spark, self.version_path(version))
            if self.marked:
                workspace.delete_path(self.spark, self.mark_path(version))
