"""Line dedup by winnowing over line hashes.

A text is a row of lines: it is cut after every line end and, as running text
often comes as one long line, after every sentence end.  What repeats is a run:
lines of RUN words or more that stood in the same order at an earlier place of
the corpus (by document, then position).  All lines of such a run are deleted;
blank ones don't count and go with the line before them, or, at the start of a
text, with the first one.

Winnowing guarantees matches from a threshold on and ignores those below
another one.  Here both are RUN words, so the window is one fingerprint wide
and none is left out: the fingerprints are the shortest runs of RUN words that
begin at a line, and the shortest that end at one: beside a match, they are the
steps by which it extends both ways.  Every longer run is a union of these, so each
fingerprint meets the first place of its own hash only, and a run is found
whatever its lines stood beside elsewhere.

Built from SQL functions only.  Runs meet by 64-bit hash and the length of
their first line.  Null text stays null.  Rows with equal doc_id and equal text
count as one document and are treated alike; null doc_ids come first.  The first
place of a line is never deleted, so no content vanishes from the corpus.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, stage

#: Ends of lines; the pieces between cuts after them spell the text.
ENDS = ("\n", ". ", "! ", "? ", "; ")
_MARK = "\x01"
_CUT = r"(?<=\n)|(?<=[.!?;] )"
#: Words of a run worth deleting.
RUN = 8
#: A run's words and lines in one number: more than the lines of any shortest run.
_LINE = 16


def _marked(text: Column) -> Column:
    for end in ENDS:
        text = F.replace(text, F.lit(end), F.lit(end + _MARK))
    return text


def lines(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    # the plain split is the fast one; a text that holds the mark itself is cut by pattern
    return F.when(F.contains(text, F.lit(_MARK)), F.split(text, _CUT, -1)).otherwise(F.split(_marked(text), _MARK, -1))


def count_lines(text: Column) -> Column:
    """The number of lines, without cutting."""
    return F.when(F.contains(text, F.lit(_MARK)), F.size(F.split(text, _CUT, -1))).otherwise(F.octet_length(_marked(text)) - F.octet_length(text) + 1)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, twin (a hash of the text), h and size of each shortest run, and its first and last position.

    A run that is shortest from both of its ends is given once.
    """
    trimmed = F.transform(lines(F.col("text")), lambda s: F.trim(s, F.lit(" \n")))
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("twin"), trimmed.alias("every"))
    at = F.filter(F.transform("every", lambda s, i: F.when(s != "", i)), lambda i: i.isNotNull())
    rows = rows.select("doc_id", "twin", F.size("every").alias("n"), F.filter("every", lambda s: s != "").alias("s"), at.alias("at"))
    # one plain array each: what follows reads single elements, never copies the document's lines
    words = F.transform("s", lambda s: F.octet_length(s) - F.octet_length(F.replace(s, F.lit(" "), F.lit(""))) + 1)
    size = F.transform("s", lambda s: F.octet_length(s))
    rows = rows.select("doc_id", "twin", "n", "at", F.transform("s", lambda s: F.xxhash64(s)).alias("h"), size.alias("size"), words.alias("words"))

    def reach(lines_from: Callable[[Column], Column]) -> Column:
        """For each line, _LINE times the words of the shortest run from it on in a direction, and its lines; less than RUN * _LINE if none."""

        def add(sums: Column, w: Column) -> Column:
            return F.when(sums >= RUN * _LINE, sums).otherwise(sums + w * _LINE + 1)

        return F.transform("words", lambda w, i: F.when(w >= RUN, w * _LINE + 1).otherwise(F.aggregate(lines_from(i), F.lit(0), add)))

    on = reach(lambda i: F.slice("words", i + 1, F.lit(RUN)))
    back = reach(lambda i: F.reverse(F.slice("words", F.greatest(i + 2 - RUN, F.lit(1)), F.least(i + 1, F.lit(RUN)))))
    rows = rows.select("doc_id", "twin", "n", "h", "size", "at", "words", on.alias("on"), back.alias("back"))
    # no filter on what was cut: it would be pushed below the cut and cut every text twice
    rows = rows.select("*", F.explode(F.when(F.size("h") > 0, F.sequence(F.lit(0), F.size("h") - 1))).alias("i"))
    on, back = F.get("on", F.col("i")), F.get("back", F.col("i"))
    # a run back from its last line that has RUN words without that line is shortest from one end only
    back = F.when(back - F.get("words", F.col("i")) * _LINE >= RUN * _LINE, back % _LINE)
    rows = rows.select("doc_id", "twin", "n", "h", "size", "at", "i", F.when(on >= RUN * _LINE, on % _LINE).alias("on"), back.alias("back"))
    starts = F.array(F.struct(F.col("i").alias("first"), F.col("on").alias("k")), F.struct((F.col("i") - F.col("back") + 1).alias("first"), F.col("back").alias("k")))
    one = F.when(F.col("back").isNull(), F.slice(starts, 1, 1)).otherwise(starts)
    rows = rows.select("doc_id", "twin", "n", "h", "size", "at", F.inline(one)).where("k IS NOT NULL")
    first = F.col("first")
    return rows.select(
        "doc_id",
        "twin",
        F.when(F.col("k") == 1, F.get("h", first)).otherwise(F.xxhash64(F.slice("h", first + 1, F.col("k")))).alias("h"),
        F.get("size", first).alias("size"),
        F.when(first == 0, 0).otherwise(F.get("at", first)).alias("pos"),
        (F.coalesce(F.get("at", first + F.col("k")), F.col("n")) - 1).alias("end"),
    )


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, twin and the ascending positions of the lines to delete."""
    prints = stage(fingerprints(docs), "fingerprints", compression="zstd")
    # the first document of each run that stands twice; null ids come first
    least = F.when(F.count("doc_id") == F.count(F.lit(1)), F.min("doc_id")).alias("first")
    twice = prints.groupBy("h", "size").agg(least, F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    twice = stage(twice, "twice")  # two plain exchanges meet: a run that fills a partition can be split
    own = F.col("doc_id").eqNullSafe(F.col("first")).alias("own")
    met = stage(prints.join(twice, ["h", "size"]).select(*prints.columns, own), "met", compression="zstd")
    discard(prints, twice)
    # in its first document a run may stand again
    place = F.struct("twin", "pos")
    again = met.where("own").groupBy("h", "size").agg(F.min(place).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = met.where("own").join(again, ["h", "size"]).where(place != F.col("least"))
    span = ["doc_id", "twin", "pos", "end"]
    spans = met.where("NOT own").select(*span).unionByName(later.select(*span))
    every = F.flatten(F.transform(F.collect_list(F.struct("pos", "end")), lambda x: F.sequence(x["pos"], x["end"])))
    return spans.groupBy("doc_id", "twin").agg(F.array_sort(F.array_distinct(every)).alias("gone"))


def without(parts: Column, gone: Column) -> Column:
    """The parts between those at ascending positions, as one text; reads each part once."""

    def between(own: Column) -> Column:
        """Inside the function both are values: no plan can cut the text again for each gap."""
        parts, gone = own["parts"], own["gone"]

        def gap(j: Column) -> Column:
            start = F.coalesce(F.get(gone, j - 1), F.lit(-1)) + 1
            return F.slice(parts, start + 1, F.coalesce(F.get(gone, j), F.size(parts)) - start)

        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), gap)), "")

    return F.get(F.transform(F.array(F.struct(parts.alias("parts"), gone.alias("gone"))), between), 0)


def dedup(docs: DataFrame) -> DataFrame:
    """The documents with all their columns, text without its later repeated runs, and
    n_lines, gone (the positions of the deleted lines; null where nothing was deleted) and left
    (the share of its characters that a text keeps; 1 where nothing was deleted).
    Where all lines are gone, size(gone) is n_lines.

    Input columns named n_lines, gone or left give way to these.
    """
    own = [c for c in docs.columns if c != "text"]
    found = repeats(docs.select("doc_id", "text"))
    told = docs.select(F.struct(*docs.columns).alias("d"))
    same = F.col("d.doc_id").eqNullSafe(found["doc_id"]) & (F.xxhash64("d.text") == found["twin"])
    # only texts that lose something are cut again
    cut = told.join(found, same, "left").select("d", "gone", F.when(F.col("gone").isNotNull(), lines(F.col("d.text"))).alias("parts"))
    kept = F.when(F.col("gone").isNotNull(), without(F.col("parts"), F.col("gone"))).otherwise(F.col("d.text"))
    kept = cut.select("d", "gone", kept.alias("kept"))
    added = {
        "n_lines": count_lines(F.col("d.text")),
        "gone": F.col("gone"),
        "left": F.when(F.col("gone").isNull(), F.lit(1.0)).otherwise(F.length("kept") / F.length("d.text")),
    }
    return kept.select(*[F.col(f"d.`{c}`").alias(c) for c in own if c not in added], F.col("kept").alias("text"), *[x.alias(c) for c, x in added.items()])
