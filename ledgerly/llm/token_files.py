"""Token ids in Parquet list columns.

File format: one directory of Parquet files, in the order of their names, rows
in ascending document order.  Columns: ``doc_id``, ``n_tokens`` and ``ids``
(list of 32-bit ids).  Data pages are written in version 2 with dictionary
encoding where it pays and delta binary packing elsewhere, with bounded row
groups and pages and with page indexes, so that a reader takes the metadata
columns alone, or the pages of a few documents, without touching the rest.

Null text counts as empty (its list holds the end id only); equal doc_ids are
kept, in the order of their texts; an empty table gives an empty directory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of a row group and of a page before encoding.
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2_000


def encode(docs: DataFrame, tokenizer: str, end_id: int, blanks: bool) -> DataFrame:
    """doc_id, n_tokens and ids of every row; tokenizer names an installed public file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        from .tokens import encoder, tokenizer_path

        enc = encoder(tokenizer_path(tokenizer), blanks)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                ids, n = enc.encode(b.column(1).to_pylist())
                ends = np.cumsum(n + 1)
                flat = np.full(int(ends[-1]), end_id, np.int32)
                own = np.ones(len(flat), bool)
                own[ends - 1] = False
                flat[own] = ids
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n + 1, pa.int64()), lists], ["doc_id", "n_tokens", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids array<int>")


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, blanks: bool) -> None:
    """Encodes whole texts and writes them in ascending doc_id order.

    The texts are range-partitioned, not the ids, and each range is sorted
    before it is encoded; the number of files follows the input.
    """
    ranges = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    encode(ranges, tokenizer, end_id, blanks).write.options(
        **{
            "parquet.writer.version": "v2",
            "parquet.block.size": str(ROW_GROUP_BYTES),
            "parquet.page.size": str(PAGE_BYTES),
            "parquet.page.row.count.limit": str(PAGE_ROWS),
            "parquet.enable.dictionary": "true",
            "compression": "zstd",
        }
    ).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The written rows; select ``doc_id`` and ``n_tokens`` to read metadata only."""
    return spark.read.parquet(path)


def read_back(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read from the files.

    ``start`` counts the ids of all documents before it: the totals of the
    files come from their metadata columns (one row a file, summed in order),
    the rest from a running sum within the file.  ``ids_crc32`` is the unsigned
    crc32 of the document's ids as little-endian unsigned 32-bit integers.
    """
    place = [F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")]
    totals = files.select("doc_id", "n_tokens", place[0]).groupBy("file").agg(F.sum("n_tokens").alias("total"), F.min("doc_id").alias("first"))
    earlier = Window.orderBy("first", "file").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("file", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for b in batches:
            flat = b.column(0).values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            at = b.column(0).offsets.to_numpy()
            crc = pa.array([zlib.crc32(flat[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[1:], crc], [*b.schema.names[1:], "ids_crc32"])

    kind = files.schema["doc_id"].dataType.simpleString()
    rows = files.select("ids", "doc_id", "n_tokens", *place).mapInArrow(run, f"doc_id {kind}, n_tokens long, file string, row long, ids_crc32 long")
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return local.join(bases, "file").select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
