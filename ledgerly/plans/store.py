"""A store of Parquet tables whose state changes by one atomic rename.

Every write makes new data folders; a manifest lists the folders of each table.
A reader sees the manifest it opened.  Publishing writes the next manifest
under a temporary name and renames it to ``manifest-<n>.json``; a rename to a
name that exists fails, so two writers can't both publish version n.  What is
never published does not exist.
"""

from __future__ import annotations

import json
import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TABLES, ddl, names


log = logging.getLogger("ledgerly.store")


class StoreError(Exception):
    """The store is absent, invalid, or was changed by another writer."""


class Store:
    def __init__(self, spark: SparkSession, path: str, amount: str = "decimal(20,2)", read_only: bool = False, ledger: str = "manifest"):
        self.spark, self.path, self.amount, self.read_only, self.ledger = spark, path.rstrip("/"), amount, read_only, ledger
        at = self._at(self.path)
        self.fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        if read_only and not self.fs.exists(at):
            raise StoreError(f"no store at {path}")
        if not read_only:
            self.fs.mkdirs(at)
        self.version, self.tables = self._latest()
        if read_only and not self.version:
            raise StoreError(f"the store at {path} is empty")

    def _at(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _text(self, path: str) -> str:
        stream = self.fs.open(self._at(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _latest(self) -> tuple[int, dict[str, list[str]]]:
        found = list(self.fs.globStatus(self._at(f"{self.path}/{self.ledger}-*.json")) or [])
        if not self.read_only:
            # an interrupted copy may leave a manifest without content, in which nothing can be lost
            for empty in [s for s in found if not s.getLen()]:
                log.warning("removed %s: it is empty", empty.getPath().getName())
                self.fs.delete(empty.getPath(), False)
            found = [s for s in found if s.getLen()]
        versions = sorted(int(s.getPath().getName()[len(self.ledger) + 1 : -5]) for s in found)
        if not versions:
            return 0, {}
        try:
            tables = json.loads(self._text(f"{self.path}/{self.ledger}-{versions[-1]}.json"))
        except ValueError as e:
            raise StoreError(f"invalid manifest {versions[-1]} at {self.path}") from e
        return versions[-1], tables

    def read(self, table: str, folders: list[str] | None = None) -> DataFrame:
        """A table's live rows.  Columns that older folders lack are null."""
        live = self.tables.get(table, []) if folders is None else folders
        schema = ddl(table, self.amount)
        if not live:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in live])

    def write(self, table: str, rows: DataFrame) -> str:
        """Writes rows that nobody sees yet; returns their folder."""
        if table not in TABLES:
            raise StoreError(f"unknown table {table}")
        folder = f"{table}/{uuid.uuid4().hex}"
        rows.select(*names(table)).write.parquet(f"{self.path}/{folder}")
        return folder

    def publish(self, tables: dict[str, list[str]]) -> None:
        """Makes the given tables consist of the given folders, all at once."""
        if self.read_only:
            raise StoreError("the store is open for reading only")
        after = {**self.tables, **tables}
        temporary = self._at(f"{self.path}/.{uuid.uuid4().hex}.json")
        stream = self.fs.create(temporary, False)
        try:
            stream.write(json.dumps(after, indent=1).encode())
        finally:
            stream.close()
        target = self._at(f"{self.path}/{self.ledger}-{self.version + 1}.json")
        if self.fs.exists(target) or not self.fs.rename(temporary, target):
            self.fs.delete(temporary, False)
            raise StoreError("another writer published first")
        self.version, self.tables = self.version + 1, after

    def append(self, table: str, rows: DataFrame) -> None:
        self.publish({table: [*self.tables.get(table, []), self.write(table, rows)]})

    def upsert(self, table: str, row: dict, key: list[str]) -> None:
        """Replaces the rows of a small table that share the key."""
        new = self.spark.createDataFrame([tuple(row.get(n) for n in names(table))], ddl(table, self.amount))
        old = self.read(table).join(F.broadcast(new.select(*key)), key, "left_anti")  # one row
        self.publish({table: [self.write(table, old.unionByName(new).coalesce(1))]})

    def vacuum(self) -> int:
        """Removes folders that no manifest of either ledger lists; returns how many."""
        keep = set()
        for name in ("manifest", "audit"):
            _, tables = Store(self.spark, self.path, ledger=name)._latest()
            keep.update(f for folders in tables.values() for f in folders)
        gone = 0
        for t in TABLES:
            for s in self.fs.globStatus(self._at(f"{self.path}/{t}/*")) or []:
                if f"{t}/{s.getPath().getName()}" not in keep:
                    self.fs.delete(s.getPath(), True)
                    gone += 1
        return gone
