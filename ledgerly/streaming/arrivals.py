"""Snapshots as they arrive: a file stream whose batches go through the runner.

The stream only notices files; a cut is still applied whole, in the order of
its date, under the same guards and the same idempotency, so a batch that is
repeated after a failure is skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.runner import Result, Runner
from ..sources import snapshots


#: The columns of the binary file source; only path and length are read.
_FILES = "path string, modificationTime timestamp, length long, content binary"


class ArrivalError(Exception):
    """A cut failed; the stream stops before it counts the batch as done."""


def watch(runner: Runner, folder: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Starts to apply the snapshots that land in a folder."""
    files = runner.spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", runner.s.file_glob).load(folder).select("path", "length")

    def apply(batch: DataFrame, _: int) -> None:
        found = [snapshots.dated(runner.spark, snapshots.inspect(runner.spark, r["path"], r["length"]), runner.s) for r in batch.collect()]  # a row a file
        for file in sorted(found, key=lambda f: (f.snapshot_date, f.order, f.name)):
            done: Result = runner.process(file)
            if done.exit_code:
                raise ArrivalError(f"{file.name}: {done.reason}")

    writer = files.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
