"""Intermediate tables in the cluster's shared folder, so that plans stay short and lost executors cost nothing."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def folder(spark: SparkSession, label: str) -> str:
    """A new path under ``spark.checkpoint.dir``; where that is unset (one machine), under a folder of this process."""
    base = spark.conf.get(_SETTING, None)
    if not base:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError(f"{_SETTING} must name a folder that all executors share")
        own = tempfile.mkdtemp(prefix="ledgerly-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        base = f"file://{own}"
        spark.conf.set(_SETTING, base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The table, written once and read from there."""
    path = folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(*jobs: Callable[[], Any]) -> list[Any]:
    """The results of independent jobs, which share the cluster: one alone seldom fills it to its end."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(job) for job in jobs]
        return [r.result() for r in running]
