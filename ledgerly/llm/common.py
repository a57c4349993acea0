"""What the operators share: scratch tables in the cluster's shared folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"
#: Shuffle files of a written table go as soon as it is written.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names.

    Only where the session names none and runs on one machine (tests) a folder
    is made and named; it goes away with the process.
    """
    base = spark.conf.get(_SETTING, None)
    if not base:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError(f"{_SETTING} must name a folder that all executors share")
        own = tempfile.mkdtemp(prefix="ledgerly-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        base = f"file://{own}"
        spark.conf.set(_SETTING, base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Writes a table to the shared folder and reads it again: lineage ends there and lost executors cost nothing."""
    spark, path = df.sparkSession, scratch(df.sparkSession, label)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*staged: DataFrame) -> None:
    """Removes staged tables that no later result reads."""
    for df in staged:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_memory: dict = {}


def remembered(make: Callable, *args):
    """What an operator keeps in a worker process from task to task: ``make(*args)``.

    Worker processes serve one operator after the other.  Only one memory is
    kept: where another operator's was, it is given back to the system first.
    """
    key = (make, *args)
    if key not in _memory:
        if _memory:
            _memory.clear()
            release()
        _memory[key] = make(*args)
    return _memory[key]


def release() -> None:
    """Gives freed memory of this process back to the system, where it can."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: it keeps what it keeps


def components(edges: DataFrame) -> DataFrame:
    """v and component (the smallest id reachable) of every end of the edges (a, b).

    Every vertex takes the smallest label among its neighbours, then the label
    of its label, until nothing changes; each round is written, so the lineage
    stays short.  The number of rounds grows with the logarithm of the longest chain.
    """
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))  # the edges are worked out once
    both = stage(edges.where("a != b").select(F.inline(ways)).distinct(), "edges")
    labels = stage(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("l")).select("v", F.least("v", "l").alias("l")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("v")).groupBy("a").agg(F.min("l").alias("near"))
        hooked = labels.join(near, F.col("v") == F.col("a")).select("v", "l", F.least("l", "near").alias("now"))
        root = labels.select(F.col("v").alias("r"), F.col("l").alias("up"))
        after = stage(hooked.join(root, F.col("now") == F.col("r"), "left").select("v", F.least("now", "up").alias("l"), (F.least("now", "up") != F.col("l")).alias("moved")), "labels")
        done = after.where("moved").isEmpty()
        discard(labels)
        labels = after
        if done:
            discard(both)
            return labels.select("v", F.col("l").alias("component"))
