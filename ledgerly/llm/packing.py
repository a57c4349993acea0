"""Best-fit packing of token pieces into sequences, planned over a length histogram.

Documents are cut into pieces of at most ``capacity`` ids (only longer ones;
the first piece may be shorter).  How many pieces have each length is all the
planner needs: it places whole runs of equally long pieces into whole runs of
equally filled sequences, longest first, each into the fullest sequences that
still take it (best fit decreasing).  The plan has a few rows per length
whatever the number of documents.  Then a piece takes the slot that the plan
holds for its rank among the pieces of its length; ranks are counted within
the task that cut the piece and shifted by the counts of the tasks before it,
so that a length half of all pieces share is ranked in parallel.

Null text counts as empty; every document has one piece at least; equal
doc_ids are kept apart by nothing but their rows; an empty table gives none.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

CAPACITY = 2048


def cut(docs: DataFrame, tokenizer: str, end_id: int, blanks: bool, capacity: int = CAPACITY, keep: tuple[str, ...] = (), ids: bool = False) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids_crc32, and
    task and rank (its rank among the pieces of its length which its task cut).

    ``keep`` names columns to carry along, ``ids`` adds the ids themselves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        import numpy as np
        from pyspark import TaskContext

        from .tokens import encoder, tokenizer_path

        enc, task = encoder(tokenizer_path(tokenizer), blanks), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                flat, n = enc.encode(b.column(0).to_pylist())
                ends = np.cumsum(n + 1)
                every = np.full(int(ends[-1]), end_id, "<u4")
                own = np.ones(len(every), bool)
                own[ends - 1] = False
                every[own] = flat
                pieces = -(-(n + 1) // capacity)
                doc = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                size = np.repeat(n + 1, pieces)
                short = size - (np.repeat(pieces, pieces) - 1) * capacity  # of the first piece
                length = np.where(piece == 0, short, capacity)
                start = np.where(piece == 0, 0, short + (piece - 1) * capacity)
                lo = np.repeat(ends - n - 1, pieces) + start
                crc = [zlib.crc32(every[x : x + k]) for x, k in zip(lo, length, strict=True)]
                order = np.argsort(length, kind="stable")
                groups = length[order]
                inside = np.arange(len(groups)) - np.searchsorted(groups, groups)
                rank = np.empty(len(groups), np.int64)
                rank[order] = seen[groups] + inside
                seen += np.bincount(length, minlength=capacity + 1)
                out = [*(c.take(pa.array(doc)) for c in b.columns[1:]), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(np.full(len(doc), task), pa.int32()), pa.array(rank)]
                names = [*b.schema.names[1:], "piece", "start", "length", "ids_crc32", "task", "rank"]
                if ids:  # pieces cover the documents' ids without a gap
                    out.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32()), pa.array(every.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    columns = ["doc_id", *keep]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return docs.select("text", *columns).mapInArrow(run, f"{kinds}, piece int, start long, length long, ids_crc32 long, task int, rank long" + ", ids array<int>" * ids)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, pieces, first sequence, pieces a sequence, offset).

    The k-th piece of a row goes to sequence ``first + k // each`` at
    ``offset + k % each * length``.  Best fit decreasing: every run of pieces
    goes to the sequences with the least room that is enough.
    """
    rows, made = [], 0
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left: runs (first sequence, how many)
    sizes: list[int] = []  # the rooms that have runs, ascending

    def leave(left: int, run: tuple[int, int]) -> None:
        if left and run[1]:
            if not room[left]:
                bisect.insort(sizes, left)
            room[left].append(run)

    for length in sorted((k for k, n in histogram.items() if n), reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect.bisect_left(sizes, length)
            if at < len(sizes):
                space = sizes[at]
                first, many = room[space].pop()
                if not room[space]:
                    sizes.pop(at)
                each = min(space // length, max(1, left // many) if left >= many else 1)
                used = min(many, left // each)
                rows.append((length, rank, used * each, first, each, capacity - space))
                leave(space, (first + used, many - used))
                leave(space - each * length, (first, used))
                rank, left = rank + used * each, left - used * each
            else:
                each = min(capacity // length, left)
                used = left // each
                rows.append((length, rank, used * each, made, each, 0))
                leave(capacity - each * length, (made, used))
                made += used
                rank, left = rank + used * each, left - used * each
    return rows


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with sequence_id and offset.  ``pieces`` must be a written table (see ``common.stage``): it is read three times."""
    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    rows = plan(histogram, capacity)
    spark = pieces.sparkSession
    slots = spark.createDataFrame(rows, "length long, first_rank long, pieces long, first_sequence long, each long, at long")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["length", "task"]).withColumn("rank", F.col("base") + F.col("rank"))
    # a few rows a length, whatever the input: the plan's size is bounded
    k = F.col("rank") - F.col("first_rank")
    taken = ranked.join(F.broadcast(slots), "length").where((k >= 0) & (k < F.col("pieces")))
    return taken.select(
        *[c for c in pieces.columns if c not in ("task", "rank")],
        (F.col("first_sequence") + F.floor(k / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(k, F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids and doc_ids: the training sequences themselves.  ``packed`` needs the pieces' ids; a sequence is bounded."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
