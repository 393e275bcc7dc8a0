"""Registered queries of the training-data operators: production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floe.llm import centroids, conversations, decontaminate, extract, fmindex, jaccard, language, packing, quality, sharding, spots, statements, suffix, warc
from floe.llm.common import held_out
from floe.session import prepare

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Callable[..., DataFrame]):
        LLM_QUERIES[name] = lambda spark, sf_dir: function(lambda table: prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet"))
        if sql is not None:
            LLM_ORACLES[name] = sql.strip()
        return function

    return register


@query("op1_html_extraction")
def op1_html_extraction(read) -> DataFrame:
    pages = read("pages")
    return extract.extract(pages, extract.fit(pages))


@query("op2_jaccard_join")
def op2_jaccard_join(read) -> DataFrame:
    return jaccard.similar(read("documents"), n=3, percent=90)


WINDOWS_SQL = """
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
    spot AS (SELECT doc_id, unnest(range(1, len(words) - 33)) AS pos, words FROM w WHERE len(words) >= 35),
    hashed AS (SELECT doc_id, pos, md5(array_to_string(words[pos:pos + 34], ' ')) AS h FROM spot),
    again AS (SELECT h FROM hashed GROUP BY h HAVING count(*) > 1),
    gone AS (SELECT DISTINCT doc_id, pos + k AS place FROM (SELECT doc_id, pos, unnest(range(0, 35)) AS k FROM hashed SEMI JOIN again USING (h))),
    each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM w),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS body FROM each ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id),
    lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
    SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(lost.n, 0)::BIGINT AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""


@query("op3_fm_index", WINDOWS_SQL)
def op3_fm_index(read) -> DataFrame:
    return fmindex.remove_repeats(read("documents"), width=35).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_quality")
def op4_quality(read) -> DataFrame:
    docs = read("documents")
    scored = quality.score(docs, quality.fit(docs, read("labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query(
    "op5_warc",
    """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
    d AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest, max(page_id) OVER (PARTITION BY sha1(body)) AS top FROM p)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to
    FROM d
    """,
)
def op5_warc(read) -> DataFrame:
    captures = warc.archive(read("pages"))
    return captures.select(
        "page_id",
        F.coalesce("origin.payload_bytes", "payload_bytes").alias("payload_bytes"),
        F.coalesce("payload_sha1", F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        "record_type",
        F.col("origin.page_id").alias("refers_to"),
    )


@query("op6_suffix_array")
def op6_suffix_array(read) -> DataFrame:
    cut = suffix.remove_repeats(read("documents"), width=200)
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_packing")
def op7_packing(read) -> DataFrame:
    packed = packing.pack(read("documents"), packing.default_tokenizer())
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op8_spot_signatures")
def op8_spot_signatures(read) -> DataFrame:
    return spots.compare_edits(read("documents"))


@query("op9_language")
def op9_language(read) -> DataFrame:
    docs = read("documents")
    return language.identify(docs, language.fit(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op10_decontamination")
def op10_decontamination(read) -> DataFrame:
    return decontaminate.leaks(read("documents"), read("benchmark"))


@query("op11_conversation_repair", statements.REPAIR_SQL)
def op11_conversation_repair(read) -> DataFrame:
    return conversations.repaired(read("conversations"))


@query("op12_sharded_lloyd", statements.lloyd_sql())
def op12_sharded_lloyd(read) -> DataFrame:
    return centroids.clustered(read("embeddings"))


@query("op13_external_shuffle")
def op13_external_shuffle(read) -> DataFrame:
    text = F.col("record.text")
    return sharding.sharded(read("documents")).select(
        "record.doc_id",
        sharding.record_bytes(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


LLM_QUERIES["pipeline"] = lambda spark, sf_dir: corpus_pipeline.run(prepare(spark), sf_dir)
if corpus_pipeline.ORACLE_SQL is not None:
    LLM_ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
