"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facilitymetrics.llm import conversations, oracle, quality, warc
from facilitymetrics.llm.decontam import contained_items
from facilitymetrics.llm.html_text import extracted
from facilitymetrics.llm.importance import resampled
from facilitymetrics.llm.lm_score import scored
from facilitymetrics.llm.near_dup import near_duplicates
from facilitymetrics.llm.packing import packed
from facilitymetrics.llm.repeats import without_repeats
from facilitymetrics.llm.scratch import scratch_dir, written
from facilitymetrics.llm.secrets import scan_documents
from facilitymetrics.llm.toxicity import toxicity_scores
from facilitymetrics.llm.vector_dup import near_vectors

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_documents(docs).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(_table(spark, sf_dir, "documents")).drop("kept_text")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op5_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = near_duplicates(docs, width=3, percent=85)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target set is the documents labelled as good."""
    good = _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return scored(_table(spark, sf_dir, "documents").select("doc_id", "text"), good)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"), tokenizer_path(), 2048, tokenizer_path("byte_bpe_50k.tiktoken"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity_scores(docs, _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", "evidence")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    page = r"<urn:page:(-?\d*)>"
    found = warc.read_archives(spark, path).where("kind <> 'gap'").select(
        F.regexp_extract("record_id", page, 1).try_cast("long").alias("page_id"),
        F.octet_length("payload").cast("long").alias("bytes"),
        "payload_digest",
        F.col("kind").alias("record_type"),
        F.regexp_extract("refers_to", page, 1).try_cast("long").alias("refers_to"),
    )
    found = written(found, "records")
    # A revisit has the payload of the response with its digest.
    responses = found.where("record_type = 'response'").groupBy("payload_digest").agg(F.max("bytes").alias("full"))
    revisits = found.where("record_type = 'revisit'").join(responses, "payload_digest", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return found.where("record_type <> 'revisit'").withColumnRenamed("bytes", "payload_bytes").select(columns).union(
        revisits.withColumnRenamed("full", "payload_bytes").select(columns)
    )


def op10_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), longest=1)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired(conversations.damaged(_table(spark, sf_dir, "conversations")))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.judged(quality.ledger(_table(spark, sf_dir, "documents")), quality.PRODUCTION)
    base = F.col("failed_bits").bitwiseAND(F.lit(quality.BASE.mask)) != 0
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "kept", "failed_bits",
    )


def queries() -> dict[str, Query]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_secret_scan": op2_secret_scan,
        "op3_substring_dedup": op3_substring_dedup,
        "op4_html_extraction": op4_html_extraction,
        "op5_minhash_near_dup": op5_minhash_near_dup,
        "op6_lm_scoring": op6_lm_scoring,
        "op7_best_fit_packing": op7_best_fit_packing,
        "op8_toxicity": op8_toxicity,
        "op9_warc": op9_warc,
        "op10_embedding_near_dup": op10_embedding_near_dup,
        "op11_importance_resampling": op11_importance_resampling,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_quality_rules": op13_quality_rules,
    }


def oracle_sql() -> dict[str, str]:
    return oracle.statements()
