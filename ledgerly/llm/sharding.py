"""Sharding by a hierarchical weighted hash tree.

Shards hang in racks, racks in regions.  A row descends the tree: on each
level every child draws ``-ln(u) / weight`` with ``u`` hashed from the key and
the child's identity, and the smallest draw wins.  A child wins in proportion
to its weight, and when a subtree's weight changes only the draws of its own
ancestors change, so rows move into or out of that subtree and nowhere else.

Everything is built from SQL functions; the text itself is never shuffled.
Null keys share one draw; null text counts as empty; equal keys share a shard;
rows that are equal in every respect take neighbouring slots in any order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slots are counted in this many chunks per shard, so that no task numbers a whole shard.
CHUNKS = 256


@dataclass(frozen=True)
class Leaf:
    """One shard and where it hangs."""

    shard: int
    region: int
    rack: int
    weight: float = 1.0


def topology(shards: int, per_rack: int = 2, racks: int = 2) -> tuple[Leaf, ...]:
    """Shards fill racks and regions in order.  Only where ``shards`` fills whole
    regions does growth by one open a region of its own (see ``grow``)."""
    size = per_rack * racks
    return tuple(Leaf(s, s // size, s // per_rack % racks) for s in range(shards))


def grow(tree: tuple[Leaf, ...], weight: float = 1.0) -> tuple[Leaf, ...]:
    """One more shard, in a new region: no other subtree's weight changes, so rows move only into it."""
    return (*tree, Leaf(max(x.shard for x in tree) + 1, max(x.region for x in tree) + 1, 0, weight))


def _draw(key: Column, level: str, node: tuple[int, ...], weight: float) -> Column:
    h = F.xxhash64(key, F.lit(level), *[F.lit(i) for i in node])
    u = (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.ln(u) / F.lit(float(weight))


def _descend(key: Column, level: str, children: list[tuple[tuple[int, ...], float, Column]]) -> Column:
    """The outcome of the child with the smallest draw; a tie goes to the smaller node."""
    if len(children) == 1:
        return children[0][2]
    draws = [F.struct(_draw(key, level, node, w).alias("d"), F.lit(i).alias("i")) for i, (node, w, _) in enumerate(children)]
    won = F.least(*draws)["i"]
    out = children[-1][2]
    for i, (_, _, outcome) in list(enumerate(children))[-2::-1]:
        out = F.when(won == i, outcome).otherwise(out)
    return out


def shard_of(key: Column, tree: tuple[Leaf, ...]) -> Column:
    """The shard of a key: region, rack and shard level in turn."""
    regions = []
    for r in sorted({x.region for x in tree}):
        racks = []
        for k in sorted({x.rack for x in tree if x.region == r}):
            own = [x for x in tree if (x.region, x.rack) == (r, k)]
            leaves = [((r, k, x.shard), x.weight, F.lit(x.shard)) for x in own]
            racks.append(((r, k), sum(x.weight for x in own), _descend(key, "shard", leaves)))
        regions.append(((r,), sum(w for _, w, _ in racks), _descend(key, "rack", racks)))
    return _descend(key, "region", regions).cast("int")


def assign(df: DataFrame, tree: tuple[Leaf, ...], key: str = "doc_id", text: str = "text", chunks: int = CHUNKS) -> DataFrame:
    """key, size, text_crc32, shard, slot and grown_shard of every row.

    Slots are gapless from 0 in each shard: a row's slot is the number of rows
    in earlier chunks of its shard plus its rank in its chunk.
    """
    words = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = df.select(
        F.col(key).alias(key),
        (F.octet_length(words) + F.lit(1)).cast("long").alias("size"),
        F.crc32(words).alias("text_crc32"),
        shard_of(F.col(key), tree).alias("shard"),
        shard_of(F.col(key), grow(tree)).alias("grown_shard"),
        F.pmod(F.xxhash64(F.col(key), F.lit("slot")), F.lit(chunks)).cast("int").alias("chunk"),
    )
    # shards x chunks rows, whatever the input
    counts = rows.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rank = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy(key, "size", "text_crc32"))
    ranked = rows.withColumn("rank", rank)
    return ranked.join(F.broadcast(counts), ["shard", "chunk"]).select(
        key, "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - 1).cast("long").alias("slot"), "grown_shard"
    )
