"""Rows that micro-batches leave behind, merged as they grow old, so that a stream of any length keeps few folders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = tuple[int, int]

EVERY = 10


class Runs:
    """`<root>/run=<first>-<last>/` holds what the batches first..last left.

    `every` runs of one size are merged into one of the next, so n batches keep about `every` * log(n) folders and a row
    is written about log(n) times. A run counts once its `_SUCCESS` is there, and hides the runs within it. These stay
    for `every` more batches, for readers that have just looked; then they are removed. A batch that is run again
    replaces its own folder, and a merge that was broken off is done again or by the next larger one.
    """

    def __init__(self, spark: SparkSession, root: str, every: int = EVERY):
        if every < 2:
            raise ValueError("at least two runs make a larger one")
        self.spark, self.root, self.every = spark, root.rstrip("/"), every

    def folder(self, run: Run) -> str:
        return f"{self.root}/run={run[0]}-{run[1]}"

    def _at(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def complete(self) -> list[Run]:
        """All runs that are whole, also those within others."""
        fs, root = self._at(self.root)
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        found = []
        for name in names:
            if name.startswith("run="):
                first, _, last = name[4:].partition("-")
                if fs.exists(self._at(f"{self.root}/{name}/_SUCCESS")[1]):
                    found.append((int(first), int(last)))
        return sorted(found)

    @staticmethod
    def _hidden(run: Run, by: list[Run]) -> bool:
        return any(other != run and other[0] <= run[0] and run[1] <= other[1] for other in by)

    def current(self) -> list[Run]:
        """The runs that a reader takes: each batch is in exactly one of them."""
        whole = self.complete()
        return [run for run in whole if not self._hidden(run, whole)]

    def read(self, runs: list[Run] | None = None) -> DataFrame:
        runs = self.current() if runs is None else runs
        if not runs:
            raise ValueError(f"no batch has been written to {self.root}")
        return self.spark.read.parquet(*[self.folder(run) for run in runs])

    def add(self, rows: DataFrame, number: int, merge: Callable[[DataFrame], DataFrame]) -> None:
        """Write a batch, merge what is due (`merge` reduces rows to those still wanted), and remove what has been hidden for long."""
        rows.write.mode("overwrite").parquet(self.folder((number, number)))
        size = self.every
        while (number + 1) % size == 0:
            due = (number + 1 - size, number)
            inside = [run for run in self.current() if due[0] <= run[0] and run[1] <= due[1] and run != due]
            if inside:
                merge(self.read(inside)).write.mode("overwrite").parquet(self.folder(due))
            size *= self.every
        whole = self.complete()
        old = [run for run in whole if run[1] <= number - self.every]
        for run in whole:
            if self._hidden(run, old):
                fs, path = self._at(self.folder(run))
                fs.delete(path, True)
