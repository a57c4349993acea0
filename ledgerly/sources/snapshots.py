"""Snapshot files: discovery, content hash, footer, contract check, snapshot date.

Files are reached through Hadoop's file system, so any store that Spark reads
will do; hashes and footers are read on executors or from Spark's own schema.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Contract, Settings
from ..functions import expressions as X


class SnapshotError(Exception):
    """A file that can't be a snapshot."""


@dataclass(frozen=True)
class SnapshotFile:
    path: str
    name: str
    size_bytes: int
    sha256: str
    row_count: int
    types: dict[str, str] = field(default_factory=dict)
    snapshot_date: date | None = None
    date_source: str = ""
    order: int = 0

    @property
    def fingerprint(self) -> str:
        """Of the sorted names and types."""
        return hashlib.sha256(json.dumps(sorted(self.types.items())).encode()).hexdigest()[:16]


def discover(spark: SparkSession, where: str, glob: str = "*.parquet") -> list[tuple[str, int]]:
    """Paths and sizes: a file or folder itself, or the files of a folder that match, by name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        raise SnapshotError(f"{where} does not exist")
    status = fs.getFileStatus(path)
    if status.isFile() or where.rstrip("/").endswith(".parquet"):
        return [(status.getPath().toString(), status.getLen())]
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, glob)) or []
    return sorted((s.getPath().toString(), s.getLen()) for s in found)


def content_hash(spark: SparkSession, path: str) -> str:
    """SHA-256 of a file's bytes, streamed in 1 MiB pieces.  A snapshot that is a folder
    of files is known by their names, sizes and store checksums (times where the store
    has none), so that no bytes are read."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getFileStatus(at).isDirectory():
        found, files = [], fs.listFiles(at, True)
        while files.hasNext():
            f = files.next()
            if not f.getPath().getName().startswith(("_", ".")):
                sum_ = fs.getFileChecksum(f.getPath())
                found.append((f.getPath().getName(), f.getLen(), sum_.toString() if sum_ else str(f.getModificationTime())))
        return hashlib.sha256(json.dumps(sorted(found)).encode()).hexdigest()
    digest = spark._jvm.java.security.MessageDigest.getInstance("SHA-256")
    stream = spark._jvm.java.security.DigestInputStream(fs.open(at), digest)
    try:
        spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, spark._jvm.java.io.OutputStream.nullOutputStream(), 1 << 20, False)
    finally:
        stream.close()
    return bytes(b & 0xFF for b in digest.digest()).hex()


def _family(kind: str) -> str:
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        return "number"
    return "any" if kind == "void" else "string" if kind in ("string", "binary") or kind.startswith(("varchar", "char")) else kind


def check_schema(types: dict[str, str], contract: Contract) -> list[str]:
    """Problems of a file's columns; order and extra columns are none.  All-null columns fit anything."""
    out = [f"missing column {c}" for c in contract.families if c not in types]
    for c, wanted in contract.families.items():
        if c in types and _family(types[c]) not in (*wanted, "any"):
            out.append(f"column {c} is {types[c]}, expected {' or '.join(wanted)}")
    return out


def read(spark: SparkSession, path: str) -> DataFrame:
    """Raw rows with source_row_number, counted by the reader from 1."""
    return spark.read.parquet(path).withColumn("source_row_number", F.col("_metadata.row_index") + 1)


def inspect(spark: SparkSession, path: str, size: int) -> SnapshotFile:
    """What a file says about itself; counting rows reads footers only."""
    try:
        rows = spark.read.parquet(path)
        types, n = dict(rows.dtypes), rows.count()
    except Exception as e:
        raise SnapshotError(f"{path} is not readable Parquet: {e}") from e
    return SnapshotFile(path, path.rstrip("/").rsplit("/", 1)[-1], size, content_hash(spark, path), n, types)


def dated(spark: SparkSession, file: SnapshotFile, s: Settings, given: date | None = None) -> SnapshotFile:
    """With its date, by the first rule of ``date_resolution`` that gives one."""
    for rule in s.date_resolution:
        found, order = None, 0
        if rule == "cli":
            found = given
        elif rule == "filename_iso" and (m := re.search(r"\d{4}-\d{2}-\d{2}", file.name)):
            try:
                found = date.fromisoformat(m[0])
            except ValueError:
                found = None
        elif rule == "declared_sequence" and file.name in s.declared_sequence:
            day, order = s.declared_sequence[file.name]
            found = date.fromisoformat(day)
        elif rule == "max_content_date" and "date" in file.types:
            found = spark.read.parquet(file.path).select(F.max(X.parsed_date(F.col("date").cast("string"), s.contract))).first()[0]
        if found:
            return replace(file, snapshot_date=found, date_source=rule, order=order)
    raise SnapshotError(f"no snapshot date for {file.name}")


def candidates(spark: SparkSession, where: str, s: Settings, given: date | None = None) -> list[SnapshotFile]:
    """All snapshots under a path in the order of their dates."""
    found = [dated(spark, inspect(spark, p, n), s, given) for p, n in discover(spark, where, s.file_glob)]
    if not found:
        raise SnapshotError(f"no snapshot under {where}")
    return sorted(found, key=lambda f: (f.snapshot_date, f.order, f.name))
