"""The opN queries: each applies one operator to its whole table."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, brown, cotraining, fm_index, k2treap, line_dedup, merkle, packing, phrase_mining, simhash,
               substring_dedup, suffix_dedup, topk)
from .common import table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


@query
def op1_topk_search(spark, sf_dir):
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors.filter(F.col("vec_id") % 20 == 0), vectors, k=20)


@query
def op2_simhash_near_dedup(spark, sf_dir):
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, bits=3)
    return out.select("doc_id", "fingerprint", "component_id")


def packed(docs: DataFrame) -> DataFrame:
    # the ids of byte_bpe_50k.json; its vocabulary also comes as a rank file
    out = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                      "sequence_id", "offset")


@query
def op3_bm25_packing(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents"))


@query
def op4_merkle_fingerprints(spark, sf_dir):
    out = merkle.compare_with_edits(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                      "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query
def op5_line_dedup(spark, sf_dir):
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents"), bits=3, similarity=0.8, sketch=True)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def _removed():
    """Number of symbols under the removed spans."""
    return F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])


@query
def op6_suffix_dedup(spark, sf_dir):
    out = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", _removed().alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_brown_lm(spark, sf_dir):
    return brown.brown_scores(table(spark, sf_dir, "documents"))


@query
def op8_substring_dedup(spark, sf_dir):
    out = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", _removed().alias("n_removed"),
                      F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op9_bpe_roundtrip(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encode_documents(table(spark, sf_dir, "documents"), path)
    return bpe.decode_documents(ids, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256)
        .alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op10_quality_classifier(spark, sf_dir):
    return cotraining.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_k2treap_search(spark, sf_dir):
    return k2treap.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


@query
def op12_phrase_collocations(spark, sf_dir):
    return phrase_mining.collocations(table(spark, sf_dir, "documents"), least=10, top=2000, percent=50)


@query
def op13_fm_decontamination(spark, sf_dir):
    out = fm_index.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return out.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                      (F.size("spans") > 0).alias("contaminated"))
