"""One query per operator: whole tables, production parameters, digest columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_tree, decontaminate, embedding_forest, jaccard, line_dedup, packing, sharding, token_files, toxicity, url_rules
from .common import scratch, stage, table


def op1_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -7 of control strings, through the prefix tree and back."""
    text = "</s>[INST] ok [/INST]"
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    back = chat_tree.read_back(*chat_tree.build(told.unionByName(more)))

    def turn(t: Column) -> Column:
        role, said = chat_tree.read_turn(t["segment"])
        return F.concat(role, F.lit("\n"), said, F.lit("\n"))

    turns = F.array_join(F.transform("turns", turn), "")
    loss = F.array_join(F.transform("turns", lambda t: chat_tree.unescape(F.coalesce(t["loss"], F.lit("")))), "")
    formatted = F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + F.length(t["segment"]))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        formatted.alias("formatted_chars"),
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 16 shards under the law ``key``."""
    out = sharding.assign(table(spark, sf_dir, "documents"), sharding.topology(16))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item within its edit budget of a passage of a document."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), shortest=1)


URL_RULES = [
    url_rules.Rule("block", "com", "/en/"),
    url_rules.Rule("allow", "example.com", "/en/7"),
    url_rules.Rule("allow", "net", "/de/"),
    url_rules.Rule("block", "example.net", "/de/8"),
    url_rules.Rule("block", "org", "/es/"),
]


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the listed rules, else by rules mined from the labels of pages (quality 0 is bad)."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("bad"))
    return url_rules.judge(table(spark, sf_dir, "pages"), labels, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op5_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all embeddings within their labels at a cosine of 0.93."""
    return embedding_forest.near_duplicates(table(spark, sf_dir, "embeddings"), 0.93)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text as ids in Parquet list columns, read back."""
    path = scratch(spark, "token-ids")
    token_files.write(table(spark, sf_dir, "documents"), path, "word_bpe_49k.json", 1, blanks=False)
    return token_files.read_back(token_files.read(spark, path))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by 4-word shingles at a Jaccard similarity of 0.85."""
    return jaccard.groups(table(spark, sf_dir, "documents"), words=4, percent=85).select("doc_id", "n_shingles", "component_id")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the later repeats of runs of lines; gone_lines are positions."""
    out = line_dedup.dedup(table(spark, sf_dir, "documents"))
    gone = F.coalesce(F.col("gone"), F.array().cast("array<int>"))
    return out.select("doc_id", "n_lines", F.size(gone).alias("n_gone"), F.array_join(gone, ",").alias("gone_lines"), "text")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of at most 2048 ids, packed best-fit."""
    pieces = stage(packing.cut(table(spark, sf_dir, "documents"), "byte_bpe_50k.json", 0, blanks=True), "pieces")
    return packing.pack(pieces)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text's toxicity, learned from the labels of the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


QUERIES = {f.__name__: f for f in (op1_chat_tree, op2_sharding, op3_decontamination, op4_url_rules, op5_embedding_forest, op6_token_files, op7_jaccard_join, op8_line_dedup, op9_packing, op10_toxicity)}

def _escaped_length(x: str) -> str:
    controls = "|".join("".join(f"\\{c}" if c in "|[]" else c for c in s) for s in chat_tree.CONTROLS)
    return f"(length({x}) + length({x}) - length(replace({x}, '\\', '')) + 2 * len(regexp_extract_all({x}, '{controls}')))"


ORACLE_SQL: dict[str, str] = {
    "op1_chat_tree": f"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), convs AS (
            SELECT conv_id, count(*)::BIGINT AS n_turns,
                sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
                coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
                sum(32 + {_escaped_length("role")} + {_escaped_length("text")})::BIGINT AS formatted_chars
            FROM rows GROUP BY conv_id
        )
        SELECT conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM convs
    """,
    "op7_jaccard_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS x FROM words
        ), shingles AS (
            SELECT doc_id, len(x) AS n, unnest(x) AS s FROM sets
        ), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
            GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
        ), reach(a, b) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
        )
        SELECT doc_id, CAST(len(x) AS BIGINT) AS n_shingles, (SELECT min(b) FROM reach WHERE reach.a = sets.doc_id) AS component_id FROM sets
    """,
}
