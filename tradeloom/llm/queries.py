"""The registered queries opN_<name> and `pipeline`, with SQL twins where SQL can express them."""

from pyspark.sql import functions as F

import corpus_pipeline
from tradeloom.llm import (
    centroids, decontaminate, fingerprints, html_text, line_dedup, merkle, mixing, near_dedup, quality, suffix_dedup, tokens, topk,
    toxicity,
)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, tokens.read_vocabulary(spark)).select("doc_id", "n_words", "n_tokens")


def op2_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_quality(spark, sf_dir):
    scored = quality.score_quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scored.select("doc_id", "quality_score", "accepted")


def op4_decontaminate(spark, sf_dir):
    marked = decontaminate.mark_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op5_fingerprints(spark, sf_dir):
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op6_html_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_text(pages).select("page_id", "url", "text", "n_chars")


def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op8_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op9_line_dedup(spark, sf_dir):
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op10_mixing(spark, sf_dir):
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_top_k(spark, sf_dir):
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"))


def op12_centroids(spark, sf_dir):
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_merkle(spark, sf_dir):
    listed = merkle.manifest(table(spark, sf_dir, "documents"))
    return listed.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_near_dedup": op2_near_dedup,
    "op3_quality": op3_quality,
    "op4_decontaminate": op4_decontaminate,
    "op5_fingerprints": op5_fingerprints,
    "op6_html_text": op6_html_text,
    "op7_toxicity": op7_toxicity,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_mixing": op10_mixing,
    "op11_top_k": op11_top_k,
    "op12_centroids": op12_centroids,
    "op13_merkle": op13_merkle,
    "pipeline": corpus_pipeline.run,
}
ORACLE_SQL = {
    "op4_decontaminate": decontaminate.ORACLE_SQL,
    "op10_mixing": mixing.ORACLE_SQL,
    "op11_top_k": topk.ORACLE_SQL,
    "op12_centroids": centroids.ORACLE_SQL,
    "op13_merkle": merkle.ORACLE_SQL,
}
