"""Tables that micro-batches add to, with reads that stay bounded.

A batch writes a folder of its own (`run=.../epoch=N`), which a replay overwrites.  When `every`
folders have come together, the writer folds them and the last snapshot into a new snapshot, which
says up to which epoch of each run it goes.  A reader takes the newest finished snapshot and the
folders after it, so it opens a bounded number of folders however many batches there were.  The
snapshot before and its folders stay for readers that have begun with them; older ones are removed.
One query at a time writes to a table; any number may read.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Folders after which they are folded.
EVERY = 20
_SNAPSHOT, _COVERS = "snapshot=", "_covers"


class _Folder:
    """The parts of a table's folder, by Hadoop's file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.path, root = path, self.hadoop.Path(path)
        self.files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        self.snapshots: dict[int, dict[str, int]] = {}
        self.batches: list[tuple[str, int]] = []
        if not self.files.exists(root):
            return
        for name in self._names(path):
            if name.startswith(_SNAPSHOT) and self._has(f"{path}/{name}/{_COVERS}"):
                self.snapshots[int(name.removeprefix(_SNAPSHOT))] = json.loads(self._text(f"{path}/{name}/{_COVERS}"))
            elif name.startswith("run="):
                for epoch in self._names(f"{path}/{name}"):
                    if self._has(f"{path}/{name}/{epoch}/_SUCCESS"):
                        self.batches.append((name.removeprefix("run="), int(epoch.removeprefix("epoch="))))

    def _names(self, path: str) -> list[str]:
        return [s.getPath().getName() for s in self.files.listStatus(self.hadoop.Path(path)) if s.isDirectory()]

    def _has(self, path: str) -> bool:
        return self.files.exists(self.hadoop.Path(path))

    def _text(self, path: str) -> str:
        stream = self.files.open(self.hadoop.Path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    @property
    def newest(self) -> int:
        return max(self.snapshots, default=0)

    def open_batches(self) -> list[tuple[str, int]]:
        covers = self.snapshots.get(self.newest, {})
        return [(run, epoch) for run, epoch in self.batches if epoch > covers.get(run, -2)]

    def place(self, run: str, epoch: int) -> str:
        return f"{self.path}/run={run}/epoch={epoch}"

    def current(self) -> list[str]:
        snapshot = [f"{self.path}/{_SNAPSHOT}{self.newest}"] if self.snapshots else []
        return snapshot + [self.place(*b) for b in self.open_batches()]

    def finish(self, number: int, covers: dict[str, int]) -> None:
        """Make a written snapshot the newest, by one rename; remove what only older ones need."""
        place = f"{self.path}/{_SNAPSHOT}{number}/{_COVERS}"
        stream = self.files.create(self.hadoop.Path(place + ".tmp"), True)
        stream.write(json.dumps(covers).encode())
        stream.close()
        self.files.rename(self.hadoop.Path(place + ".tmp"), self.hadoop.Path(place))
        before = self.snapshots.get(self.newest, {})
        gone = [f"{self.path}/{_SNAPSHOT}{n}" for n in self.snapshots if n < self.newest]
        gone += [self.place(run, epoch) for run, epoch in self.batches if epoch <= before.get(run, -2)]
        for folder in gone:
            self.files.delete(self.hadoop.Path(folder), True)


def run_of(batch: DataFrame) -> str:
    """The id of the streaming query that hands over a batch; it lives in its checkpoint, so a new
    checkpoint, whose epochs begin at 0 again, gets folders of its own."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def add_batch(rows: DataFrame, path: str, run: str, epoch: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/run={run}/epoch={epoch}")


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of the newest snapshot and of all batches after it; empty before any write."""
    current = _Folder(spark, path).current()
    return spark.read.schema(schema).parquet(*current) if current else spark.createDataFrame([], schema)


def fold_batches(
    spark: SparkSession, path: str, schema: str, combine: Callable[[DataFrame], DataFrame], every: int = EVERY
) -> bool:
    """Write a snapshot of `combine(rows)` if `every` batches have come since the last one."""
    folder = _Folder(spark, path)
    waiting = folder.open_batches()
    if len(waiting) < every:
        return False
    number = folder.newest + 1
    combine(read_batches(spark, path, schema)).write.mode("overwrite").parquet(f"{path}/{_SNAPSHOT}{number}")
    covers = dict(folder.snapshots.get(folder.newest, {}))
    for run, epoch in waiting:
        covers[run] = max(epoch, covers.get(run, epoch))
    folder.finish(number, covers)
    return True
