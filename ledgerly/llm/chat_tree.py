"""Chat formatting as a prefix tree.

A turn is written ``<|im_start|>role<|im_sep|>text<|im_end|>``.  Control strings
inside roles and texts are broken after their first character by ``\\.`` and
backslashes are doubled, so a text never holds a control string and is read
back exactly.  Conversations that begin with the same turns share the nodes of
those turns: a node stands for a turn and all turns before it, and is named by
a hash of them: two 64-bit hashes of each turn and its place, joined over all
turns up to it.  All nodes form one stream in depth-first order, each once.

Distinct conversations, sorted by their paths of node names, are the leaves in
depth-first order.  A leaf emits the nodes that no leaf before it holds; they
are the end of its path, so they lie together in the stream as the leaf's run.
A node carries its place in the stream and the position id of its first
character (as if its conversation stood alone); a run carries the stream
intervals it attends to, one for each run its path crosses, its own last and
causal.  Characters are code points; ``tokens`` gives the same tree in ids of a
public tokenizer, with position ids.  Nothing grows with the square of a
conversation's length, and no tree ever meets in one task: leaves and nodes are
laid out by range-partitioned sorts and running sums.  A conversation itself
must fit into one row.

Null roles and texts count as empty; turns with the same number follow in the
order of role and text, and repeated rows are repeated turns; null turns come
first; rows with a null conv_id are one conversation; an empty table gives an
empty tree.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: The control strings of the template and of other common ones.
CONTROLS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
START, SEP, END = CONTROLS[:3]
TAUGHT = "assistant"


def _quoted(s: str) -> str:
    return "".join("\\" + c if c in "|[]/" else c for c in s)


_BREAK = "|".join(f"{_quoted(a)}(?={'|'.join(_quoted(c[1:]) for c in CONTROLS if c[0] == a)})" for a in "<[")


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _BREAK, r"$0\\.")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(?:(\\)|\.)", "$1")


def write_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), escape(role), F.lit(SEP), escape(text), F.lit(END))


def read_turn(segment: Column) -> tuple[Column, Column]:
    """Role and text of a written turn."""
    inner = F.substring(segment, F.lit(len(START) + 1), F.length(segment) - len(START) - len(END))
    at = F.locate(SEP, segment) - len(START)
    return unescape(F.substring(inner, F.lit(1), at - 1)), unescape(F.substring(inner, at + len(SEP), F.length(inner)))


def _paths(turns: DataFrame) -> DataFrame:
    """conv_id, segments and path (the name of the node of each turn)."""
    told = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = told.select("conv_id", F.row_number().over(order).alias("at"), write_turn(F.col("role"), F.col("text")).alias("segment"))
    so_far = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    # a running sum of bits, so that no turn copies the names before it
    name = F.concat(*[F.lpad(F.hex(F.bit_xor(F.xxhash64("segment", "at", F.lit(k))).over(so_far)), 16, "0") for k in (1, 2)])
    rows = placed.select("conv_id", "at", "segment", name.alias("node"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "node", "segment"))).alias("t"))
    return convs.select("conv_id", F.col("t.segment").alias("segments"), F.col("t.node").alias("path"))


def _numbered(ordered: DataFrame, value: Column) -> DataFrame:
    """A staged table in the order of its files, with ``before``: the sum of ``value`` over all earlier rows."""
    placed = ordered.withColumns({"file": F.col("_metadata.file_name"), "row": F.col("_metadata.row_index"), "value": value})
    totals = placed.groupBy("file").agg(F.sum("value").alias("total"))
    # files are named by the number of their range, a longer name has a larger one; one row a file
    earlier = Window.orderBy(F.length("file"), "file").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("file", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    inside = F.sum("value").over(Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1))
    rows = placed.withColumn("inside", F.coalesce(inside, F.lit(0))).join(bases, "file")
    return rows.select(*ordered.columns, (F.col("base") + F.col("inside")).alias("before"))


def build(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The nodes, the runs, and the run of every conversation (conv_id, leaf).

    Nodes: node, parent, depth, segment, length, conversations (how many pass),
    run, stream_start, position, loss_start and loss_end (the stream interval of
    a taught text; else null).  Runs: run, leaf, attends (array of run, start, end).
    """
    convs = stage(_paths(turns), "paths", compression="zstd")
    leaf = F.get("path", F.size("path") - 1)
    leaves = convs.groupBy(leaf.alias("leaf")).agg(F.first("path").alias("path"), F.first("segments").alias("segments"), F.count(F.lit(1)).alias("copies"))
    ordered = stage(leaves.repartitionByRange("path").sortWithinPartitions("path"), "leaves", compression="zstd")
    ranked = _numbered(ordered, F.lit(1)).withColumnRenamed("before", "rank")

    steps = ranked.select("rank", "leaf", "copies", F.posexplode(F.arrays_zip("path", "segments")).alias("depth", "step"))
    own = Window.partitionBy("rank").orderBy("depth")
    length = F.length("step.segments")
    steps = steps.select(
        "rank",
        "leaf",
        "copies",
        "depth",
        F.col("step.path").alias("node"),
        F.lag("step.path").over(own).alias("parent"),
        F.col("step.segments").alias("segment"),
        length.alias("length"),
        (F.sum(length).over(own) - length).alias("position"),
    )
    steps = stage(steps, "steps", compression="zstd")
    about = F.min(F.struct("rank", "depth", "parent", "position", "length")).alias("a")
    nodes = steps.groupBy("node").agg(about, F.first("segment").alias("segment"), F.sum("copies").alias("conversations"))
    nodes = nodes.select("node", F.col("a.parent").alias("parent"), F.col("a.depth").alias("depth"), "segment", F.col("a.length").alias("length"), "conversations", F.col("a.rank").alias("run"), F.col("a.position").alias("position"))
    laid = stage(nodes.repartitionByRange("run", "depth").sortWithinPartitions("run", "depth"), "nodes", compression="zstd")
    role, _ = read_turn(F.col("segment"))
    taught, start = role == TAUGHT, F.col("stream_start")
    tree = _numbered(laid, F.col("length")).withColumnRenamed("before", "stream_start")
    tree = tree.withColumns(
        {
            "loss_start": F.when(taught, start + F.locate(SEP, F.col("segment")) + len(SEP) - 1),
            "loss_end": F.when(taught, start + F.col("length") - len(END)),
        }
    )
    tree = stage(tree, "tree", compression="zstd")

    # a popular node is met by many leaves: one narrow row on its side, the other can be split
    place = stage(tree.select("node", "run", start.alias("start"), (start + F.col("length")).alias("end")), "places")
    crossed = steps.select("rank", "leaf", "node").join(place, "node").groupBy("rank", "leaf", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    runs = crossed.groupBy("rank", "leaf").agg(F.sort_array(F.collect_list(F.struct("start", "end", "run"))).alias("attends"))
    return tree, runs.withColumnRenamed("rank", "run"), convs.select("conv_id", leaf.alias("leaf"))


def read_back(tree: DataFrame, runs: DataFrame, members: DataFrame) -> DataFrame:
    """conv_id and turns (array of place, segment and loss text, in order) of every conversation, from the stream its run attends to."""
    spans = stage(runs.select("leaf", F.inline("attends")), "spans")
    start = F.col("stream_start")
    taken = F.substring("segment", F.col("loss_start") - start + 1, (F.col("loss_end") - F.col("loss_start")).cast("int"))
    told = tree.select("run", "stream_start", "segment", taken.alias("loss"))
    seen = spans.join(told, "run").where((start >= F.col("start")) & (start < F.col("end")))
    turns = stage(seen.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("stream_start", "segment", "loss"))).alias("turns")), "turns", compression="zstd")
    return members.join(turns, "leaf").select("conv_id", "turns")


def tokens(tree: DataFrame, runs: DataFrame, tokenizer: str, blanks: bool) -> tuple[DataFrame, DataFrame]:
    """Nodes and runs in ids of an installed public tokenizer.

    Nodes: node, run, depth, ids, stream_start, position_ids (those a conversation
    alone would have), loss_start and loss_end (the stream interval of a taught
    text; else null).  Runs: run, leaf, attends (array of run, start, end).  A
    turn's head, text and end are encoded apart, so the loss mask never cuts an id.
    """
    role, text = read_turn(F.col("segment"))
    head = F.substring("segment", F.lit(1), F.locate(SEP, F.col("segment")) + len(SEP) - 1)
    body = F.substring("segment", F.length(head) + 1, F.length("segment") - F.length(head) - len(END))
    rows = tree.select("node", "run", "depth", (F.col("stream_start") + F.col("length")).alias("end"), head.alias("head"), body.alias("body"), (role == TAUGHT).alias("taught"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        from .tokens import encoder, tokenizer_path

        enc = encoder(tokenizer_path(tokenizer), blanks)
        for whole in batches:
            for at in range(0, whole.num_rows, 1_000):
                b = whole.slice(at, 1_000)
                parts = [x for h, t in zip(b.column(4).to_pylist(), b.column(5).to_pylist()) for x in (h, t, END)]
                ids, n = enc.encode(parts)
                n = n.reshape(-1, 3)
                ends = np.concatenate([[0], np.cumsum(n.sum(1))])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))
                sizes = [pa.array(x, pa.int64()) for x in (n.sum(1), n[:, 0], n[:, 1])]
                yield pa.RecordBatch.from_arrays([*b.columns[:4], b.column(6), lists, *sizes], ["node", "run", "depth", "end", "taught", "ids", "n", "n_head", "n_text"])

    made = rows.mapInArrow(run, "node string, run long, depth int, end long, taught boolean, ids array<int>, n long, n_head long, n_text long")
    made = stage(made.repartitionByRange("run", "depth").sortWithinPartitions("run", "depth"), "ids", compression="zstd")
    made = stage(_numbered(made, F.col("n")), "numbered", compression="zstd")
    # intervals are beginnings of runs and end where a node does
    last = made.select("run", "end", (F.col("before") + F.col("n")).alias("to"))
    first = made.groupBy("run").agg(F.min("before").alias("from"))
    ends = stage(last.join(first, "run"), "ends")
    crossed = runs.select(F.col("run").alias("of"), "leaf", F.inline("attends")).join(ends, ["run", "end"])
    spans = crossed.groupBy("of", "leaf").agg(F.sort_array(F.collect_list(F.struct(F.col("from").alias("start"), F.col("to").alias("end"), "run"))).alias("attends"))
    spans = stage(spans.withColumnRenamed("of", "run"), "attends")
    # a run's first position: the ids of all that it attends to but itself
    sizes = F.transform(F.filter("attends", lambda x: x["run"] != F.col("run")), lambda x: x["end"] - x["start"])
    bases = spans.select("run", F.aggregate(sizes, F.lit(0).cast("long"), lambda n, x: n + x).alias("base"))
    start = F.col("before")
    rows = made.join(first, "run").join(bases, "run")
    at = F.col("base") + start - F.col("from")
    return rows.select(
        "node",
        "run",
        "depth",
        "ids",
        start.alias("stream_start"),
        F.when(F.col("n") > 0, F.sequence(at, at + F.col("n") - 1)).otherwise(F.array().cast("array<bigint>")).alias("position_ids"),
        F.when(F.col("taught"), start + F.col("n_head")).alias("loss_start"),
        F.when(F.col("taught"), start + F.col("n_head") + F.col("n_text")).alias("loss_end"),
    ), spans
