"""The queries of this folder, and the SQL that checks those which SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, divergence, fingerprints, jaccard, linededup, mixing, pii, quality, repair, suffixes, topk, toxicity, warc
from ledgerloom.llm.audit_sql import OP11_SQL, OP13_SQL
from ledgerloom.llm.common import table


def tokenizer_json(path: str | None = None) -> str:
    """The content of the tokenizer file; the driver reads it, tasks get it by broadcast."""
    with open(path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(spark)
    manifest = warc.write_archives(table(spark, sf_dir, "pages", "page_id", "url", "html"), folder)
    return warc.read_archives(manifest, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = linededup.drop_later_copies(table(spark, sf_dir, "documents", "doc_id", "text"))
    spans = F.transform("deleted", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return left.select("doc_id", "n_lines", "n_deleted", F.array_join(spans, ",").alias("deleted"), "text")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.fingerprint_edits(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents", "doc_id", "source"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    coded = bpe.round_trip(docs, tokenizer_json())
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    scored = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), toxicity.score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffixes.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return left.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter(base, pii.of_kind(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined("spans").alias("spans"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents", "text", "lang", "source"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents", "doc_id", "text"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", "good")


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repair.repair(repair.damaged(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    return found.report.join(found.digests(), "conv").select("conv_id", *counts, "repaired_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_line_dedup": op2_line_dedup,
    "op3_fingerprints": op3_fingerprints,
    "op4_mixing": op4_mixing,
    "op5_bpe": op5_bpe,
    "op6_jaccard": op6_jaccard,
    "op7_toxicity": op7_toxicity,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_topk": op9_topk,
    "op10_pii": op10_pii,
    "op11_divergence": op11_divergence,
    "op12_quality": op12_quality,
    "op13_repair": op13_repair,
}

ORACLE_SQL: dict[str, str] = {
    "op11_divergence": OP11_SQL,
    "op13_repair": OP13_SQL,
    "op9_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS w
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op1_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS payload_bytes FROM pages
        ), f AS (SELECT payload, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload)
        SELECT page_id, payload_bytes, sha256(payload) AS payload_digest,
               CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id > first THEN first END AS refers_to
        FROM p LEFT JOIN f USING (payload)
    """,
}
