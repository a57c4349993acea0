"""Near-duplicate embeddings by a forest of random-projection trees.

Vectors are compared within a label (and a dimension).  Equal vectors are one
point with a weight.  A tree splits the points of a label at the median of a
random projection, again and again, and a share of the points around the median
goes to both sides, so that close points are seldom torn apart; many trees make
it rarer still.  Points that share a leaf are compared exactly, in double
precision.  Points so close together that a cut would tear links apart are not cut.

The tops of the trees are fitted on a bounded sample and every vector is sent
through them; a node is a seed and two numbers, so a forest is small whatever the
dimension.  Leaves that are still large are cut further level by level, each at
quantiles of all of its own points, which are aggregated, never collected.  Only ids
and leaf numbers move until all leaves are known; then a vector goes to each of its
leaves once.

A pair that shares several leaves is counted in the first of them, so leaves
return one row per point (links found, and an edge of a spanning forest) and
never their pairs.  Leaves that can't be cut are compared in blocks of bounded size.

Vectors that are null, empty, zero or hold null or non-finite components, and
those with a null label, link with nothing and are their own component.  Rows
with equal vec_id are separate rows of one vector if they are equal.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, stage

#: Points that the trees are fitted on at most, those with the smallest hash of their vector.
SAMPLE = 20_000
TREES, LEAF, SPILL = 8, 400, 0.12
#: Points of a leaf that is compared at once; fewest sampled points that are split.
BLOCK, FEWEST = 2_000, 16
#: Spread of the projections of points that are not cut: of points a link apart at a cosine of about 0.93.
TIGHT = 0.26


@dataclass
class Node:
    seed: tuple
    low: float
    high: float
    left: Node | None = None
    right: Node | None = None


def _direction(seed: tuple, size: int) -> np.ndarray:
    return np.random.default_rng(_seed(*seed)).standard_normal(size)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _seed(*parts: object) -> int:
    return int.from_bytes(hashlib.blake2b(repr(parts).encode(), digest_size=8).digest(), "little")


def grow(x: np.ndarray, scale: float, seed: tuple) -> Node | None:
    """A tree over sampled unit vectors, each of which stands for ``scale`` points."""
    if len(x) * scale <= LEAF or len(x) < FEWEST:
        return None
    p = x @ _direction(seed, x.shape[1])
    if p.std() <= TIGHT:
        return None
    low, high = np.quantile(p, [0.5 - SPILL / 2, 0.5 + SPILL / 2])
    left, right = p <= high, p > low
    if left.all() or right.all():
        return None
    return Node(seed, low, high, grow(x[left], scale, (*seed, 0)), grow(x[right], scale, (*seed, 1)))


def leaves(node: Node | None, x: np.ndarray, rows: np.ndarray, name: tuple) -> Iterator[tuple[tuple, np.ndarray]]:
    """The leaves that have rows, and their rows."""
    if node is None or not len(rows):
        if len(rows):
            yield name, rows
        return
    p = x[rows] @ _direction(node.seed, x.shape[1])
    yield from leaves(node.left, x, rows[p <= node.high], (*name, 0))
    yield from leaves(node.right, x, rows[p > node.low], (*name, 1))


def _leaf_id(name: tuple) -> int:
    return _seed("leaf", *name) - (1 << 63)


def points(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows with the hash of their vector (null if it links with nothing), and the distinct vectors."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    key = F.when(F.coalesce(fine, F.lit(False)) & F.col("label").isNotNull(), F.xxhash64("label", "embedding"))
    rows = vectors.select("vec_id", "label", "embedding", key.alias("h"))
    distinct = rows.where("h IS NOT NULL").groupBy("h").agg(F.min("vec_id").alias("point"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    space = F.concat_ws("|", F.col("label").cast("string"), F.size("embedding").cast("string"))
    return rows.drop("embedding"), distinct.withColumn("space", space)


def fit(known: DataFrame) -> dict[str, list[Node | None]]:
    """Trees for each label, on a sample of SAMPLE points at most."""
    total = known.count()
    sample = known.orderBy("h").limit(SAMPLE).select("space", "embedding").toPandas()  # the documented bound
    scale, out = total / max(1, len(sample)), {}
    for space, own in sample.groupby("space"):
        x = unit(np.array(own["embedding"].tolist(), dtype=np.float64))
        out[space] = [grow(x, scale, (t, space)) for t in range(TREES)]
    return out


def route(known: DataFrame, forest: dict[str, list[Node | None]]) -> DataFrame:
    """point and leaf: a row for each leaf of a point."""
    item = known.schema["point"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spaces = np.array(b.column(0).to_pylist(), dtype=object)
            at, leaf = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for space in sorted(set(spaces)):
                rows = np.flatnonzero(spaces == space)
                x = unit(_matrix(b.column(1).take(pa.array(rows))))
                for t, tree in enumerate(forest.get(space, [None] * TREES)):
                    for name, some in leaves(tree, x, np.arange(len(rows)), (t, space)):
                        at.append(rows[some])
                        leaf.append(np.full(len(some), _leaf_id(name)))
            take = pa.array(np.concatenate(at))
            yield pa.RecordBatch.from_arrays([b.column(2).take(take), pa.array(np.concatenate(leaf))], ["point", "leaf"])

    return known.select("space", "embedding", "point").mapInArrow(run, f"point {item}, leaf long")


def _matrix(lists: pa.Array) -> np.ndarray:
    """Vectors of one dimension without nulls."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1)


def cut_large(known: DataFrame, placed: DataFrame) -> DataFrame:
    """point and leaf, where no leaf has more than BLOCK points unless they can't be cut."""
    vectors, done, level = known.select("point", "embedding"), [], 0
    while True:
        big = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("was")).where(F.col("was") > BLOCK)
        big = stage(big, "big")
        if big.isEmpty():
            return functools.reduce(DataFrame.unionByName, done, placed)
        level += 1

        def project(batches: Iterator[pa.RecordBatch], level: int = level) -> Iterator[pa.RecordBatch]:
            for b in batches:
                leaf, p = b.column(0).to_numpy(), np.zeros(b.num_rows)
                for i in np.unique(leaf):
                    rows = np.flatnonzero(leaf == i)
                    x = unit(_matrix(b.column(3).take(pa.array(rows))))
                    p[rows] = x @ _direction(("level", level, int(i)), x.shape[1])
                yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(p)], ["leaf", "was", "point", "p"])

        done.append(placed.join(big, "leaf", "left_anti"))
        inside = stage(placed.join(big, "leaf"), "inside").join(vectors, "point").select("leaf", "was", "point", "embedding")
        item = known.schema["point"].dataType.simpleString()
        inside = stage(inside.mapInArrow(project, f"leaf long, was long, point {item}, p double"), "projected")
        quantiles = F.percentile_approx("p", [0.5 - SPILL / 2, 0.5 + SPILL / 2], 1_000)
        cuts = stage(inside.groupBy("leaf").agg(quantiles.alias("q"), F.stddev_pop("p").alias("spread")), "cuts")
        side = [F.when(F.col("p") <= F.col("q")[1], 0), F.when(F.col("p") > F.col("q")[0], 1)]
        sides = F.when(F.col("spread") > TIGHT, F.array_compact(F.array(*side))).otherwise(F.array(F.lit(-1)))
        rows = inside.join(cuts, "leaf").select("leaf", "was", "point", F.explode(sides).alias("side"))
        rows = stage(rows.select("was", "point", F.when(F.col("side") < 0, F.col("leaf")).otherwise(F.xxhash64("leaf", "side", F.lit(level))).alias("leaf")), "sides")
        # one that the cut leaves as large as it was stays as it is
        stuck = stage(rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.max("was").alias("was")).where("n > 0.9 * was").select("leaf"), "stuck")
        done.append(rows.join(stuck, "leaf", "left_semi").select("point", "leaf"))
        placed = stage(rows.join(stuck, "leaf", "left_anti").select("point", "leaf"), "leaves")


def _compare(threshold: float):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        i, j = (int(block[c].iloc[0]) for c in ("i", "j"))
        point, weight, side = block["point"].to_numpy(), block["n"].to_numpy(), block["side"].to_numpy()
        x = unit(np.array(block["embedding"].tolist(), dtype=np.float64))
        # leaves before this one
        lists = [np.asarray(o) for o in block["before"]]
        wide = max(1, max(map(len, lists)))
        earlier = np.full((len(x), wide), -1, np.int64)
        has = np.zeros((len(x), wide), bool)
        for r, o in enumerate(lists):
            earlier[r, : len(o)], has[r, : len(o)] = o, True
        links, comp, edges = np.zeros(len(x), np.int64), np.arange(len(x)), {}
        for lo in range(0, len(x), 256):
            a, b = np.nonzero(x[lo : lo + 256] @ x.T >= threshold)
            a += lo
            ok = (a < b) & ((i == j) | (side[a] != side[b]))
            a, b = a[ok], b[ok]
            new = np.ones(len(a), bool)
            for at in range(0, len(a), 20_000):
                p, q = a[at : at + 20_000], b[at : at + 20_000]
                same = (earlier[p][:, :, None] == earlier[q][:, None, :]) & has[p][:, :, None] & has[q][:, None, :]
                new[at : at + 20_000] = ~same.any(axis=(1, 2))
            a, b = a[new], b[new]
            np.add.at(links, a, weight[b])
            np.add.at(links, b, weight[a])
            for p, q in zip(a.tolist(), b.tolist(), strict=True):
                if comp[p] != comp[q]:
                    edges.setdefault(p, []).append(q)
                    comp[comp == comp[q]] = comp[p]
        rows = [(point[r], int(links[r]), point[q]) for r, qs in edges.items() for q in qs[:1]]
        more = [(point[r], 0, point[q]) for r, qs in edges.items() for q in qs[1:]]
        rest = [(point[r], int(links[r]), None) for r in np.flatnonzero(links) if r not in edges]
        out = pd.DataFrame(rows + more + rest, columns=["point", "links", "other"])
        return out.astype({"links": "int64"})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    rows, distinct = points(vectors)
    known = stage(distinct, "vectors")
    placed = cut_large(known, stage(route(known, fit(known)), "leaves"))
    # parts of the leaves that are compared in blocks
    halves = placed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) * 2 / F.lit(BLOCK)).alias("m")).where(F.col("m") > 2)
    own = placed.join(stage(halves, "halves"), "leaf", "left").select("point", F.struct("leaf", F.coalesce("m", F.lit(1)).alias("m")).alias("l"))
    own = own.groupBy("point").agg(F.sort_array(F.collect_set("l")).alias("leaves"))  # a few for each tree
    sent = stage(own, "own").join(known.select("point", "n", "embedding"), "point")
    before = F.transform(F.filter("leaves", lambda l: l["leaf"] < F.col("l.leaf")), lambda l: l["leaf"])
    sent = sent.select("point", "n", "embedding", "leaves", F.explode("leaves").alias("l"))
    side = F.pmod(F.xxhash64("point", F.lit("side")), F.col("l.m"))
    sent = sent.select(F.col("l.leaf").alias("leaf"), "l.m", side.alias("side"), "point", "n", "embedding", before.alias("before"))
    sent = sent.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)).alias("o"))
    sent = sent.select("leaf", F.least("side", "o").alias("i"), F.greatest("side", "o").alias("j"), "side", "point", "n", "embedding", "before")
    item = known.schema["point"].dataType.simpleString()
    found = stage(sent.groupBy("leaf", "i", "j").applyInPandas(_compare(threshold), f"point {item}, links long, other {item}"), "links")
    links = found.groupBy("point").agg(F.sum("links").alias("links"))
    named = components(found.where("other IS NOT NULL").select(F.col("point").alias("a"), F.col("other").alias("b")))
    classes = (
        known.select("h", "point", "n")
        .join(links, "point", "left")
        .join(named, F.col("point") == F.col("v"), "left")
        .select("h", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "point").alias("component_id"))
    )
    out = rows.join(classes, "h", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
