"""Exact Jaccard join of documents in the metric space of their shingle sets.

The Jaccard distance is a metric.  Two documents link when their distance is at
most e.  The join narrows the space down until regions are small, and is exact
at every step:

1. Documents with equal sets are one class; a class has one point.
2. A set of n shingles lacks at most D = (1 - s) n of them in a linked set, so
   of its first 2 D + 1 in hash order about half at least are shared.  A point
   that shares fewer of these with others than any link needs is alone.  Of the
   points left, one that shares less than s of all its shingles with them lies
   further than e from their union, and is alone too.
3. Most points lie at distance 1 from nearly all others, where distances to
   pivots tell nothing.  So the first pivots come from an index: with rarest
   shingles first, linked points share a shingle among the first D + 1 of both.
   All points of such a shingle go to the region of one pivot, the one among
   them with the fewest shingles of its own.
4. A large region is cut anew by PIVOTS points of its own: every point goes to
   the Voronoi region of its nearest pivot, and a copy to each other pivot that
   is at most 2 e further, for by the triangle inequality a point linked to it
   may have that one as its nearest.  Points within e of a pivot join its
   component.  A region all of whose points are of one component is done.  Of
   the component of a region's pivot only those points stay that can reach any
   other point by the triangle inequality; this recurs while regions shrink.
5. A region that is small, or shrinks no more, is joined point by point, in
   blocks of bounded size; two points of one component are never compared, so
   neither are two blocks of the pivot's.  A block returns a spanning forest,
   never its pairs.

Components of the classes then come from the forests.  Shingles and classes go
by 64-bit hashes.  Null and empty texts have no shingles and link with nothing;
rows with equal doc_id are separate documents; all columns but doc_id and text
are left alone.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, discard, remembered, stage

#: Points and shingles of a block at most (a block takes two halves).
BLOCK_POINTS, BLOCK_SHINGLES = 1_024, 500_000
#: Pivots of a large region, and the share of its points that a part may have to be cut again.
PIVOTS, SHRUNK = 8, 0.6
#: Document ids that are broadcast at most (tens of MB in memory).
BROADCAST_ROWS = 1_000_000
#: Distinct words a worker remembers the hash of.
MAX_WORDS = 250_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > MAX_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: str | None, words: int) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending; a text of fewer words is one shingle."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()  # A-Z only, and white space of \\x20 \\x09-\\x0D only
    if not w:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(remembered(_Hashes).__getitem__, w), np.uint64, len(w))
    n = min(words, len(h))
    last = len(h) - n + 1
    x = h[:last].copy()
    for k in range(1, n):
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[k : last + k]
    if n < words:
        x += np.uint64(n)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    return np.unique(x.view(np.int64))


def _class(x: np.ndarray) -> int:
    """One hash for a whole set."""
    import xxhash

    return xxhash.xxh64_intdigest(x.tobytes()) - (1 << 63)


def lacking(n: int, percent: int) -> int:
    """How many of n shingles a linked set may lack."""
    return (100 - percent) * n // 100


def _read(docs: DataFrame, words: int, percent: int, whole: bool) -> DataFrame:
    """doc_id, class, n, and the first part of the shingles in hash order, or all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, 1_000):
                b = whole_batch.slice(at, 1_000)
                sets = [shingles(t, words) for t in b.column(1).to_pylist()]
                kept = sets if whole else [x[: 2 * lacking(len(x), percent) + 1] for x in sets]
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, kept)]), pa.int32()), pa.array(np.concatenate(kept)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(map(_class, sets), pa.int64()), pa.array(map(len, sets), pa.int64()), lists], ["doc_id", "class", "n", "x"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, class long, n long, x array<long>")


def _lacking(n: Column, percent: int) -> Column:
    return F.floor(F.lit(100 - percent) * n / F.lit(100)).cast("long")


def _needed(n: Column, percent: int) -> Column:
    """How many of its first shingles a linked set shares at least: the set whose
    first part ends first shares D + 1, and the smallest linked set has s n shingles."""
    return _lacking(F.ceil(F.lit(percent) * n / F.lit(100)), percent) + 1


def _join_regions(percent: int):
    """Joins the points of each region of a bucket: returns spanning forests of their links."""

    def forest(names: np.ndarray, sets: list[np.ndarray], labels: np.ndarray) -> Iterator[tuple[int, int]]:
        sizes = np.array([len(x) for x in sets])
        comp, near = np.unique(labels, return_inverse=True)[1], None
        _, number = np.unique(np.concatenate(sets), return_inverse=True)
        order = np.argsort(number, kind="stable")
        posted, start = np.repeat(np.arange(len(sets)), sizes)[order], np.searchsorted(number[order], np.arange(number.max() + 2))
        ends = np.cumsum(sizes)
        for i in np.argsort(-sizes, kind="stable"):
            window = (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i])) & (comp != comp[i])
            if near is not None:  # distances to the first pivot, and the triangle inequality
                window &= np.abs(near - near[i]) <= 1 - percent / 100 + 1e-9
            if not window.any():
                continue
            own = number[ends[i] - sizes[i] : ends[i]]
            lo, n = start[own], start[own + 1] - start[own]
            at = np.cumsum(n)
            both = np.bincount(posted[np.arange(at[-1]) + np.repeat(lo - at + n, n)], minlength=len(sets))
            union = sizes + sizes[i] - both
            if near is None:
                near = 1 - both / union
            for j in np.flatnonzero((100 * both >= percent * union) & (comp != comp[i])):
                if comp[j] != comp[i]:
                    yield names[i], names[j]
                    comp[comp == comp[j]] = comp[i]

    def run(bucket: pd.DataFrame) -> pd.DataFrame:
        edges: list[tuple[int, int]] = []
        for _, region in bucket.groupby("g", sort=False):
            names, first = np.unique(region["class"].to_numpy(), return_index=True)
            x = region["x"].to_numpy()
            if len(names) > 1:
                edges += forest(names, [np.asarray(x[k]) for k in first], region["label"].to_numpy()[first])
        return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

    return run


def _links(points: DataFrame, percent: int) -> DataFrame:
    """A forest (a, b) over the classes that spans every component of links.  points: class, n, x (staged)."""
    shared = points.select("class", "n", F.explode("x").alias("h"))
    twice = stage(shared.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "twice")
    # a point's shingles that others have too, rarest first
    known = shared.join(twice, "h").groupBy("class", "n").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("s"))
    own = F.col("n") - F.size("s")
    part = _lacking(F.col("n"), percent) + 1
    near = stage(
        known.where(F.size("s") * 100 >= F.col("n") * percent).select("class", "n", own.alias("own"), F.transform(F.slice("s", F.lit(1), F.greatest(F.lit(0), part - own).cast("int")), lambda v: v["h"]).alias("keys")),
        "near",
    )
    keys = near.select("class", "n", "own", F.explode("keys").alias("h"))
    meeting = keys.groupBy("h").agg(F.count(F.lit(1)).alias("points"), F.min(F.struct("own", "class"))["class"].alias("pivot")).where("points > 1")
    # the regions of one pivot are one region: a point stands once in it
    cells = keys.join(stage(meeting, "meeting"), "h").select(F.col("pivot").alias("g"), "class", "n").distinct()
    cells = stage(cells.withColumn("label", F.col("class")), "cells")
    sets = points.select("class", "x")
    small, large = _by_size(cells)
    joined = [_join(small.withColumn("part", F.lit(0)), sets, percent)]
    if large is not None:
        joined += _voronoi(large, sets, percent)
    return functools.reduce(DataFrame.unionByName, joined)


def _by_size(members: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Members (g, class, n, label) of the regions that one block takes, and of the others with their ``size``, if there are any."""
    sizes = members.groupBy("g").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"))
    sizes = stage(sizes.select("g", "size", ((F.col("size") > BLOCK_POINTS) | (F.col("shingles") > BLOCK_SHINGLES)).alias("big")), "sizes")
    big = sizes.where("big").select("g", "size")
    if big.isEmpty():
        return members, None
    return members.join(sizes.where("NOT big").select("g"), "g", "left_semi"), stage(members.join(big, "g"), "large")


def _join(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The forest of each part of a region; placed: g, part, class, n, label."""
    # parts share tasks: as many buckets as hold about a block each
    placed = stage(placed.select("class", "n", "label", F.xxhash64("g", "part").alias("g")), "placed")
    load = placed.agg(F.sum("n")).first()[0] or 0
    bucket = F.pmod("g", F.lit(max(1, 2 * load // BLOCK_SHINGLES)))
    return placed.drop("n").join(sets, "class").withColumn("bucket", bucket).groupBy("bucket").applyInPandas(_join_regions(percent), "a long, b long")


def _distances(members: DataFrame, sets: DataFrame, percent: int, turn: int) -> DataFrame:
    """The members with ``near``: slot, pivot, distance and linked of each pivot of their region."""
    # every slot's pivot is its member with the smallest hash
    slot = F.pmod(F.xxhash64("class", F.lit(turn)), F.lit(PIVOTS))
    pivots = members.groupBy("g", slot.alias("slot")).agg(F.min(F.struct(F.xxhash64("class", F.lit(-turn)), "class"))["class"].alias("class"))
    # one row a region, with PIVOTS sets: two plain exchanges meet, and a region that fills a partition can be split
    pivots = pivots.join(sets, "class").groupBy("g").agg(F.collect_list(F.struct("slot", F.col("class").alias("pivot"), F.col("x").alias("p"))).alias("pivots"))
    pivots = stage(pivots, "pivots", compression="zstd")
    rows = stage(members.join(sets, "class"), "sets", compression="zstd").join(pivots, "g")

    def apart(p: Column, both: Column) -> Column:
        union = F.size("x") + F.size(p["p"]) - both
        return F.struct(p["slot"].alias("slot"), p["pivot"].alias("pivot"), (F.lit(1.0) - both / union).alias("d"), (both * 100 >= union * percent).alias("linked"))

    common = F.transform("pivots", lambda p: F.struct(p.alias("p"), F.size(F.array_intersect("x", p["p"])).alias("both")))
    near = F.transform(common, lambda c: apart(c["p"], c["both"]))
    return stage(rows.select("g", "class", "n", "size", near.alias("near")), "distances")


def _voronoi(members: DataFrame, sets: DataFrame, percent: int) -> list[DataFrame]:
    """Forests of the links in large regions (g, class, n, label, size), cut by pivots again and again."""
    e, forests, turn, known = 1 - percent / 100 + 1e-9, [], 0, None
    while members is not None:
        turn += 1
        apart = _distances(members, sets, percent, turn)
        links = apart.select(F.col("class").alias("a"), F.inline("near")).where("linked AND a <> pivot").select("a", F.col("pivot").alias("b"))
        known = stage(links if known is None else links.unionByName(known), "known")
        labels = stage(components(known), "labels")
        least = F.array_min(F.transform("near", lambda p: p["d"]))
        windows = F.filter("near", lambda p: p["d"] <= least + F.lit(2 * e))
        rows = apart.select("g", "class", "n", "size", F.inline(windows)).join(labels, F.col("class") == F.col("v"), "left")
        rows = rows.select(F.xxhash64("g", "slot", F.lit(turn)).alias("g"), "class", "n", F.coalesce("component", "class").alias("label"), "pivot", "d", F.col("size").alias("before"))
        rows = stage(rows, "windows")
        # the pivot's component, and where the points of others lie
        own = rows.where("class = pivot").select("g", F.col("label").alias("major"))
        rows = rows.join(stage(own, "own"), "g")
        other = F.when(F.col("label") != F.col("major"), F.col("d"))
        reach = rows.groupBy("g").agg((F.min(other) - F.lit(e)).alias("lo"), (F.max(other) + F.lit(e)).alias("hi")).where("lo IS NOT NULL")
        rows = rows.join(stage(reach, "reach"), "g").where("label <> major OR d BETWEEN lo AND hi")
        rows = stage(rows.select("g", "class", "n", "label", "before", (F.col("label") == F.col("major")).alias("major")), "regions")
        small, large = _by_size(rows)
        forests.append(_join(small.withColumn("part", F.lit(0)), sets, percent))
        members = None
        if large is not None:
            stuck = F.col("size") > F.col("before") * SHRUNK
            forests.append(_join(_blocks(large.where(stuck)), sets, percent))
            shrunk = large.where(~stuck)
            members = None if shrunk.isEmpty() else shrunk.select("g", "class", "n", "label", "size")
    return [*forests, known]


def _blocks(members: DataFrame) -> DataFrame:
    """Parts of regions that bring every two points together that can't be of one component: g, part, class, n, label."""
    count = members.groupBy("g").agg(*[F.ceil(F.greatest(F.count(F.when(c, 1)) / F.lit(BLOCK_POINTS / 2), F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)) / F.lit(BLOCK_SHINGLES / 2))).cast("int").alias(k) for k, c in (("majors", F.col("major")), ("minors", ~F.col("major")))])
    rows = members.join(stage(count, "halves"), "g")
    half = F.pmod(F.xxhash64("class"), F.greatest(F.lit(1), F.when(F.col("major"), F.col("majors")).otherwise(F.col("minors")))).cast("int")
    rows = rows.withColumn("k", half)

    def each(n: str, i: Column, j: Column, kind: int) -> Column:
        return F.transform(F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>")), lambda o: F.xxhash64(F.lit(kind), i(o), j(o)))

    k = F.col("k")
    across = F.when(F.col("major"), each("minors", lambda o: o, lambda o: k, 1)).otherwise(each("majors", lambda o: k, lambda o: o, 1))
    among = F.when(~F.col("major"), each("minors", lambda o: F.least(k, o), lambda o: F.greatest(k, o), 0)).otherwise(F.array().cast("array<bigint>"))
    return rows.select("g", "class", "n", "label", F.explode(F.concat(across, among)).alias("part"))


def groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, class, n_shingles and component_id (the smallest doc_id reachable by links) of every document."""
    read = stage(_read(docs, words, percent, whole=False), "shingles", compression="zstd")
    docs_of = stage(read.select("doc_id", "class", "n"), "classes")
    keys = read.select("class", F.explode("x").alias("h"))
    # a shingle of two classes; copies of one text share nothing with others by that
    shared = stage(keys.groupBy("h").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi").select("h"), "shared")
    counted = keys.join(shared, "h").groupBy("class").agg(F.count(F.lit(1)).alias("c"))
    firsts = docs_of.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("first"), F.min("n").alias("n"), F.count(F.lit(1)).alias("copies"))
    enough = counted.join(firsts, "class").where(F.col("c") >= _needed(F.col("n"), percent) * F.col("copies"))
    candidates = stage(enough.select("class", "first"), "candidates")
    discard(read, shared)
    # their whole sets: the texts are read again, of few documents; texts move only where ids of a checked size don't do
    some = stage(candidates.select("first").distinct(), "some")
    some = F.broadcast(some) if some.count() <= BROADCAST_ROWS else some
    again = docs.select("doc_id", "text").join(some, F.col("doc_id").eqNullSafe(F.col("first")), "left_semi")
    whole = _read(again, words, percent, whole=True).where("n > 0")
    points = stage(whole.groupBy("class", "n").agg(F.first("x").alias("x")), "points", compression="zstd")
    found = components(_links(points, percent))
    firsts = firsts.select("class", "first")
    of_class = stage(firsts.join(found, F.col("class") == F.col("v"), "left").select("class", "first", F.coalesce("component", "class").alias("component")), "components")
    least = of_class.groupBy("component").agg(F.min("first").alias("component_id"))
    named = of_class.join(stage(least, "least"), "component").select("class", "component_id")
    named = stage(named, "named")
    out = docs_of.join(named, "class", "left")
    return out.select("doc_id", "class", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def dedup(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents, with all their columns, one of each component: that with the smallest doc_id.
    Rows that share a doc_id stay or go together."""
    first = groups(docs, words, percent).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_first"))
    return docs.join(first, docs["doc_id"].eqNullSafe(first["_first"]), "left_semi")
