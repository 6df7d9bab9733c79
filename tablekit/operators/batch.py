"""A mutation batch with savepoints (START .. SAVEPOINT .. ROLLBACK TO ..
RELEASE .. COMMIT / ROLLBACK).

Every step only extends a lazy plan; a savepoint is a reference to the frame
at that point, rolling back is using that reference again, and only
``commit`` runs a job: one write of the final state into a fresh version
directory (steps that check their rows run those checks).  ``checkpoint`` cuts
the plan of a long batch where its author says so.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tablekit.session import reliable_checkpoint
from tablekit.sources.sinks import publish


class Batch:
    def __init__(self, table: DataFrame):
        self._start = table
        self.current = table
        self._savepoints: list[tuple[str, DataFrame, int]] = []
        self.metrics: list[DataFrame] = []
        self.done = False

    def apply(self, op: Callable, *args, **kwargs) -> "Batch":
        """Run a mutation ``op(current, *args) -> (new, metrics, ...)``."""
        self._check_open()
        res = op(self.current, *args, **kwargs)
        new = res[0] if isinstance(res, tuple) else res
        if isinstance(res, tuple) and len(res) > 1:
            self.metrics.append(res[1])
        self.current = new
        return self

    def checkpoint(self) -> "Batch":
        """Materialise the current state (one job) and go on from there."""
        self._check_open()
        self.current = reliable_checkpoint(self.current)
        return self

    def savepoint(self, name: str) -> "Batch":
        self._check_open()
        self._savepoints = [s for s in self._savepoints if s[0] != name]
        self._savepoints.append((name, self.current, len(self.metrics)))
        return self

    def rollback_to(self, name: str) -> "Batch":
        """Back to the savepoint; later savepoints are discarded, this one stays."""
        self._check_open()
        names = [s[0] for s in self._savepoints]
        if name not in names:
            raise KeyError(f"SAVEPOINT {name} does not exist")
        i = names.index(name)
        _, self.current, steps = self._savepoints[i]
        del self.metrics[steps:]
        self._savepoints = self._savepoints[: i + 1]
        return self

    def release(self, name: str) -> "Batch":
        """Forget the savepoint; the data is unchanged."""
        self._check_open()
        if name not in [s[0] for s in self._savepoints]:
            raise KeyError(f"SAVEPOINT {name} does not exist")
        self._savepoints = [s for s in self._savepoints if s[0] != name]
        return self

    def commit(self, base_dir: str, version: int) -> str:
        """Write the final state once; returns the new version directory."""
        self._check_open()
        path = publish(self.current, base_dir, version)
        self.done = True
        return path

    def rollback(self) -> DataFrame:
        """Abort: nothing is written; the original table is returned."""
        self._check_open()
        self.current = self._start
        self._savepoints = []
        self.metrics = []
        self.done = True
        return self._start

    def _check_open(self):
        if self.done:
            raise RuntimeError("batch already committed or rolled back")
