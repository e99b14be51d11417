"""The registered queries: thin digests of the operators over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrace.llm import centroids, cross_polytope, decontam, filter_audit, importance, jaccard_join, langid_crf, licenses, mixing, pii, \
    secrets, suffix_dedup, toxicity
from terrace.llm.common import held_out, read


def op1_importance_resampling(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = importance.train(docs, read(spark, sf_dir, "labels"))
    s = importance.resample(importance.score(docs.select("doc_id", "text"), model))
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"), "log_ratio", "noisy_weight", "selected")


def op2_toxicity_grammar(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    grammar = toxicity.train(docs, read(spark, sf_dir, "labels"))
    s = toxicity.score(docs.select("doc_id", "text"), grammar)
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
                    (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def op3_language_crf(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    p = langid_crf.identify(docs, langid_crf.train(docs))
    return p.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "n_segments")


def op4_mixing_tree(spark, sf_dir):
    m = mixing.mix(read(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target", "taken", "shards", "shuffle_key")


def op5_cross_polytope(spark, sf_dir):
    return cross_polytope.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_jaccard_regions(spark, sf_dir):
    return jaccard_join.link_documents(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_decontamination(spark, sf_dir):
    h = decontam.find_hits(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return h.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op8_license_templates(spark, sf_dir):
    return licenses.find_licenses(read(spark, sf_dir, "documents"))


def _of_kind(number):
    return lambda b: b["kind"] == number


def op9_secret_randomness(spark, sf_dir):
    s = secrets.find(read(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", _of_kind(i))).cast("long").alias(f"n_{k}")
              for i, k in enumerate(secrets.KINDS[:3])]
    return s.select("doc_id", *counts, F.sha2(secrets.as_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                    secrets.as_text(F.col("spans")).alias("spans"))


def op10_pii_anchors(spark, sf_dir):
    p = pii.find(read(spark, sf_dir, "documents"))
    return p.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                    F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def op11_centroid_expressions(spark, sf_dir):
    return centroids.cluster(read(spark, sf_dir, "embeddings"))[0]


def op12_filter_orders(spark, sf_dir):
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_suffix_dedup(spark, sf_dir):
    return suffix_dedup.dedup(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_importance_resampling, op2_toxicity_grammar, op3_language_crf, op4_mixing_tree, op5_cross_polytope,
    op6_jaccard_regions, op7_decontamination, op8_license_templates, op9_secret_randomness, op10_pii_anchors,
    op11_centroid_expressions, op12_filter_orders, op13_suffix_dedup)}
