"""Full-refresh tables that readers never see half written.

Overwriting a folder in place deletes the old files first: a reader in between
finds nothing, and a failed run leaves nothing.  Here every refresh writes the
whole set of tables to a new version folder; one small pointer file then names
the version that holds, and readers follow it.  The pointer changes by one
rename to a name of its own (``current-<number>``, the highest holds), which
file systems and object stores do atomically, so all tables of a refresh change
together and a failed run leaves the old version in place.  A running reader keeps the files
of the version it started with until that is dropped (``drop_old``).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from .history import _below, _fs

POINTER = "current-"


class Published:
    """The versions below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _pointers(self) -> list[tuple[int, str]]:
        """(number, version) of the pointers, oldest first."""
        out = []
        for path in _below(self.spark, os.path.join(self.root, POINTER + "*")):
            number, version = path.rsplit("/", 1)[1][len(POINTER):].split("-", 1)
            out.append((int(number), version))
        return sorted(out)

    def current(self) -> str | None:
        """The folder of the version that holds, if there is one."""
        pointers = self._pointers()
        return os.path.join(self.root, pointers[-1][1]) if pointers else None

    def new_version(self) -> str:
        """A folder to write the next version to; nobody reads it yet."""
        return os.path.join(self.root, "v" + uuid.uuid4().hex)

    def publish(self, version: str) -> None:
        """Let readers see ``version``, whole, from now on."""
        fs, p = _fs(self.spark, self.root)
        number = (self._pointers()[-1][0] if self._pointers() else 0) + 1
        name = version.rsplit("/", 1)[1]
        draft = p(os.path.join(self.root, f".draft-{uuid.uuid4().hex}"))
        fs.create(draft).close()
        if not fs.rename(draft, p(os.path.join(self.root, f"{POINTER}{number}-{name}"))):
            raise RuntimeError(f"could not publish {version}")

    def read(self, table: str) -> DataFrame:
        """A table of the version that holds, without the columns that a refresh
        stores for itself (their names begin with an underscore)."""
        version = self.current()
        if version is None:
            raise LookupError(f"nothing is published below {self.root}")
        stored = self.spark.read.parquet(os.path.join(version, table))
        own = [c for c in stored.columns if c.startswith("_")]
        return stored.drop(*own) if own else stored

    def drop_old(self, keep: int = 2) -> list[str]:
        """Delete all but the last ``keep`` published versions, and versions that
        were never published; returns their folders.  Not while a refresh runs."""
        fs, p = _fs(self.spark, self.root)
        pointers = self._pointers()
        kept = {v for _, v in pointers[-max(1, keep):]}
        gone = []
        for path in _below(self.spark, os.path.join(self.root, "v*")):
            name = path.rstrip("/").rsplit("/", 1)[1]
            if name not in kept:
                for number, version in pointers:
                    if version == name:
                        fs.delete(p(os.path.join(self.root, f"{POINTER}{number}-{version}")), False)
                fs.delete(p(path), True)
                gone.append(path)
        return gone
