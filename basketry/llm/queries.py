"""Registered queries of this subpackage and their SQL.

Each ``opN_`` query applies its operator to the whole table and derives the
contract's columns from the operator's result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (ann, hard_negatives, jaccard, langid, lines, lzprint, mixing, packing, pii, sharding, toxicity,
               vector_links, whitening)
from .common import cut, documents, read_table

SHARDS = 40


def vocabulary() -> str:
    """The public vocabulary file; every worker has the package installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxic_scores(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", "spans")


def op2_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["base"])
    of_kind = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind))
    counts = [of_kind(k).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.listed(base), 256).alias("base_sha256"),
                        pii.listed(F.col("spans")).alias("spans"))


def op3_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("row.doc_id", "n_lines", "n_removed", "text")


def op4_lempel_ziv_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lzprint.fingerprints(documents(spark, sf_dir).select("doc_id", "text"))


def op5_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, _ = sharding.shard_documents(documents(spark, sf_dir), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         F.col("place").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
                         F.col("vslot").alias("virtual_slot"))


def op6_kneser_ney_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op7_count_vector_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = jaccard.similar_groups(documents(spark, sf_dir), k=3, percent=90)
    return groups.select("doc_id", "n_shingles", "component_id")


def op8_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(vectors, F.col("vec_id") % 50 == 0, k=5)


def op9_linear_grouping_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(documents(spark, sf_dir), vocabulary())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_subset_sum_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = cut(mixing.measured(documents(spark, sf_dir)), "sizes")
    m = mixing.mix(sizes, ["doc_id"])
    return m.select("doc_id", "size", "source_size", "target",
                    (F.col("size") * F.col("repeats")).alias("taken"))


def op11_weighted_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation beyond 64 bits is null here; the operator's own column holds 38 digits."""
    white = whitening.whiten(read_table(spark, sf_dir, "embeddings"), components=8, weights="counts")
    return white.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def op12_multi_index_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links.linked_vectors(read_table(spark, sf_dir, "embeddings"), limit=0.9)


def op13_multi_index_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    mined = hard_negatives.mine(v.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


QUERIES = {
    "op1_crf_toxicity": op1_crf_toxicity,
    "op2_weak_supervision_pii": op2_weak_supervision_pii,
    "op3_fuzzy_lines": op3_fuzzy_lines,
    "op4_lempel_ziv_fingerprints": op4_lempel_ziv_fingerprints,
    "op5_virtual_slots": op5_virtual_slots,
    "op6_kneser_ney_language": op6_kneser_ney_language,
    "op7_count_vector_jaccard": op7_count_vector_jaccard,
    "op8_learned_partitions": op8_learned_partitions,
    "op9_linear_grouping_packing": op9_linear_grouping_packing,
    "op10_subset_sum_mixing": op10_subset_sum_mixing,
    "op11_weighted_whitening": op11_weighted_whitening,
    "op12_multi_index_duplicates": op12_multi_index_duplicates,
    "op13_multi_index_negatives": op13_multi_index_negatives,
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# The other operators learn, estimate or search for a near-optimum: no SQL
# gives their rows; their tests use brute force, round trips and held-out rows.
ORACLE = {
    "op7_count_vector_jaccard": f"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                            '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
        s AS (
          SELECT doc_id, unnest(list_distinct(CASE
                   WHEN len(ws) >= 3 THEN [ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FOR i IN range(1, len(ws) - 1)]
                   WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)) AS sh FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
                  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
                  WHERE 100 * c >= 90 * (p.n + q.n - c)),
        reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
        SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles,
               least(d.doc_id, coalesce(min(reach.y), d.doc_id)) AS component_id
        FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach ON reach.x = d.doc_id
        GROUP BY d.doc_id""",
}
