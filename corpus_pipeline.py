"""The corpus pipeline: documents through five stages, each written and read again.

Toxic documents go; later repeats of runs of lines go, and with them documents
that held nothing else; of each group of near copies the document with the
smallest doc_id stays; documents that hold a benchmark item go; the rest is
packed into sequences of at most 2,048 ids.  A stage works on all that its
predecessor kept.  Clean documents pass every stage unchanged.

Null texts count as empty and pass all stages but the fifth, which gives them the end
id alone; so do null doc_ids.  Rows that share a doc_id stay or go together in the
third stage.  Further columns pass the first four stages whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerly.llm import decontaminate, jaccard, line_dedup, packing, toxicity
from ledgerly.llm.common import stage, table


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _numbered(docs: DataFrame) -> DataFrame:
    """The documents with numbers for names, so that no column hides one that an operator adds."""
    return docs.toDF(*[c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that op10 predicts toxic, as learned from ``labels``; where nothing could be learned, none goes."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(_numbered(docs), model)
    return scored.where(F.col("toxicity") < toxicity.THRESHOLD).drop("toxicity").toDF(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without later repeats of runs of lines; documents that are blank after the cut go."""
    # a filter on the lines, not on the text: Spark would work out the text twice
    own = _numbered(docs)
    out = line_dedup.dedup(own).where(F.col("gone").isNull() | (F.size("gone") < F.col("n_lines")))
    if "n_chars" in docs.columns:
        chars = own.columns[docs.columns.index("n_chars")]
        out = out.withColumn(chars, F.when(F.col("gone").isNull(), F.col(chars)).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*own.columns).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of five-word shingles at 0.8 hold together."""
    return jaccard.dedup(docs, words=5, percent=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item within its edit budget."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), shortest=1)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of all documents with their ids and their places in sequences of at most 2,048."""
    pieces = stage(packing.cut(docs, "byte_bpe_50k.json", 0, blanks=True, ids=True), "pieces", compression="zstd")
    return packing.pack(pieces)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("best_fit_packing", pack_sequences),
]

#: SQL expresses none of learned scores, edit distances or tokenizers; tests/llm hold run() to a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), name)
    return docs
