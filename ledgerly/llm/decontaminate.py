"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are compared as words: lower case, any run of other
characters is one blank.  An item of m characters may differ from a passage by
k = rate * m edits.  Cut into k + 1 pieces, at least one piece stands in the
passage unchanged, so an Aho-Corasick automaton over all pieces finds every
candidate place, and Myers' bit-parallel algorithm gives the exact distance of
the item to the best substring around it.

The items are a query set of bounded blocks; a block goes to every task and
each block is one pass over the documents, which are never shuffled.

An item of fewer than ``MIN_CHARS`` characters has no budget: it matches where it
stands word for word, between word borders.  ``shortest`` says how many characters an
item must have at all; the registered query and the pipeline look for every item that
holds a letter or digit (1).  Null texts hold nothing, null and empty items never match; equal items
match alike under each item_id; equal documents give equal rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Edits allowed for each character of an item, and the shortest piece; the budget shrinks for it.
RATE, PIECE = 0.08, 12
#: Characters below which an item has no budget, and the fewest that it must have unless ``shortest`` says otherwise.
MIN_CHARS = 24
#: Characters and items of a block of the query set.
BLOCK_CHARS, BLOCK_ITEMS = 4_000_000, 20_000

_WORD = re.compile(r"[^\W_]+")


def normal(text: str | None) -> str:
    return " ".join(_WORD.findall((text or "").lower()))


def budget(m: int, rate: float = RATE) -> int:
    return max(0, min(int(rate * m), m // PIECE - 1))


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of nearly equal length, with their places."""
    cuts = [i * len(item) // (k + 1) for i in range(k + 2)]
    return [(x, item[x:y]) for x, y in zip(cuts, cuts[1:])]


class Myers:
    """Bit-parallel edit distance of one pattern, a column of the matrix in two integers."""

    def __init__(self, pattern: str):
        self.m, self.full, self.top = len(pattern), (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
        self.eq: dict[str, int] = {}
        for i, c in enumerate(pattern):
            self.eq[c] = self.eq.get(c, 0) | 1 << i

    def best(self, text: str, anchored: bool = False) -> tuple[int, int]:
        """The least distance of the pattern to a substring of the text, and where the first best one ends.
        ``anchored`` substrings begin with the text."""
        pv, mv, score, full, top, get = self.full, 0, self.m, self.full, self.top, self.eq.get
        least, at, carry = self.m, 0, int(anchored)
        for j, c in enumerate(text, 1):
            eq = get(c, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | (full & ~(xh | pv))
            mh = pv & xh
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
                if score < least:
                    least, at = score, j
            ph = (ph << 1 | carry) & full
            mh = mh << 1 & full
            pv = mh | (full & ~(xv | ph))
            mv = ph & xv
        return least, at


class Matcher:
    """All items of a block against one text after the other."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE, shortest: int = MIN_CHARS):
        import ahocorasick

        self.auto, owners = ahocorasick.Automaton(), {}
        self.items: list[tuple[str, int, list[int]]] = []  # text, budget, item_ids
        same: dict[str, list[int]] = {}
        for i, text in items:
            if len(text) >= max(1, shortest):
                same.setdefault(text, []).append(i)
        for text, ids in same.items():
            k = budget(len(text), rate) if len(text) >= MIN_CHARS else 0
            for at, p in pieces(text, k):
                owners.setdefault(p, []).append((len(self.items), at))
            self.items.append((text, k, ids))
        for p, own in owners.items():
            self.auto.add_word(p, (len(p), own))
        if owners:
            self.auto.make_automaton()
        self.myers: dict[int, tuple[Myers, Myers]] = {}

    def find(self, text: str) -> list[tuple[int, int, int, int, int]]:
        """(item_id, distance, start, end, budget) of every item within its budget, at its first best place."""
        if not self.items or not text:
            return []
        windows: dict[int, list[list[int]]] = {}
        whole: dict[int, tuple[int, int]] = {}
        for end, (size, own) in self.auto.iter(text):
            for n, at in own:
                item, k, _ = self.items[n]
                if len(item) < MIN_CHARS:
                    first, after = end + 1 - size, end + 1
                    if (not first or text[first - 1] == " ") and (after == len(text) or text[after] == " "):
                        whole.setdefault(n, (first, after))
                    continue
                lo, hi = max(0, end + 1 - size - at - k), min(len(text), end + 1 - size - at + len(item) + k)
                spans = windows.setdefault(n, [])
                if spans and lo <= spans[-1][1] and lo >= spans[-1][0]:
                    spans[-1][1] = max(spans[-1][1], hi)
                else:
                    spans.append([lo, hi])
        out = [(i, 0, *span, 0) for n, span in whole.items() for i in self.items[n][2]]
        for n, spans in windows.items():
            item, k, ids = self.items[n]
            if n not in self.myers:
                self.myers[n] = (Myers(item), Myers(item[::-1]))
            there, back = self.myers[n]
            best = (k + 1, 0, 0)
            for lo, hi in spans:
                d, end = there.best(text[lo:hi])
                if d < best[0]:
                    end += lo
                    _, size = back.best(text[max(0, end - len(item) - k) : end][::-1], anchored=True)
                    best = (d, end - size, end)
            if best[0] <= k:
                out += [(i, *best, k) for i in ids]
        return out


def blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The query set, normal, in blocks of bounded size."""
    block, chars = [], 0
    for r in items.select("item_id", "text").toLocalIterator():
        text = normal(r["text"])
        block.append((r["item_id"], text))
        chars += len(text)
        if chars >= BLOCK_CHARS or len(block) >= BLOCK_ITEMS:
            yield block
            block, chars = [], 0
    if block:
        yield block


def matches(docs: DataFrame, items: DataFrame, rate: float = RATE, shortest: int = MIN_CHARS) -> DataFrame:
    """doc_id, item_id, distance, start and end (in the normal form of the text) and budget of every hit."""
    doc, item = docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {doc}, item_id {item}, distance int, start int, end int, budget int"
    out = docs.sparkSession.createDataFrame([], schema)
    for block in blocks(items):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            m = Matcher(block, rate, shortest)
            for b in batches:
                rows = [(d, *hit) for d, t in zip(*(c.to_pylist() for c in b.columns), strict=True) for hit in m.find(normal(t))]
                if rows:
                    kinds = [b.schema.field(0).type, None, *[pa.int32()] * 4]
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "item_id", "distance", "start", "end", "budget"])

        out = out.unionByName(docs.select("doc_id", "text").mapInArrow(run, schema))
    return out


def clean(docs: DataFrame, items: DataFrame, rate: float = RATE, shortest: int = MIN_CHARS) -> DataFrame:
    """The documents, with all their columns, that hold no item."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    at = docs.columns.index("text")
    for block in blocks(items):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            m = Matcher(block, rate, shortest)
            for b in batches:
                yield b.filter(pa.array([not m.find(normal(t)) for t in b.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, kinds)
    return docs


def spans_text(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The matched passages in normal form beside their items: a report for people."""
    words = F.trim(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}]+", " "))
    return found.join(docs.select("doc_id", words.alias("words")), "doc_id").select(*found.columns, F.substring("words", F.col("start") + 1, F.col("end") - F.col("start")).alias("passage"))
