"""One query for each operator of this package, over its whole table, and SQL where it can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from quayside.llm import (
    alignment,
    jaccard,
    licenses,
    mixing,
    periodic_runs,
    pieces,
    ppm,
    quality,
    secret_scan,
    sharding,
    token_counts,
    top_k,
    toxicity,
)
from quayside.llm.tables import read
from quayside.session import apply_settings

MODEL = "piece_bpe_32k.model"
RANKS = "byte_bpe_50k.tiktoken"
BYTE_LEVEL = "byte_bpe_50k.json"


def op1_exact_top_k(spark, sf_dir):
    vectors = read(apply_settings(spark), sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op2_secret_scans(spark, sf_dir):
    return secret_scan.report(read(apply_settings(spark), sf_dir, "documents"))


def op3_ngram_jaccard_join(spark, sf_dir):
    found = jaccard.classes(read(apply_settings(spark), sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "class_texts", "links")


def op4_quality_rules(spark, sf_dir):
    docs = read(apply_settings(spark), sf_dir, "documents")
    return quality.verdicts(docs, read(spark, sf_dir, "labels"))


def op5_sentencepiece(spark, sf_dir):
    return pieces.digests(read(apply_settings(spark), sf_dir, "documents"), public_tokenizers.path(MODEL))


def op6_license_scans(spark, sf_dir):
    docs = read(apply_settings(spark), sf_dir, "documents")
    return licenses.scan(docs, licenses.TEMPLATES, edits=True)


def op7_token_counts(spark, sf_dir):
    docs = read(apply_settings(spark), sf_dir, "documents")
    counts = token_counts.lengths(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return token_counts.totals(counts)


def op8_ppm_scoring(spark, sf_dir):
    return ppm.score(read(apply_settings(spark), sf_dir, "documents"))


def op9_sharding(spark, sf_dir):
    return sharding.shard(read(apply_settings(spark), sf_dir, "documents"))


def op10_source_mixing(spark, sf_dir):
    found = mixing.copies(read(apply_settings(spark), sf_dir, "documents"))
    return found.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def op11_periodic_runs(spark, sf_dir):
    return periodic_runs.scan(read(apply_settings(spark), sf_dir, "documents"), plant=True, texts=False)


def op12_cross_tokenizer_alignment(spark, sf_dir):
    docs = read(apply_settings(spark), sf_dir, "documents")
    return alignment.align(docs, public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(MODEL))


def op13_toxicity(spark, sf_dir):
    docs = read(apply_settings(spark), sf_dir, "documents")
    return toxicity.judged(docs, read(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_top_k,
        op2_secret_scans,
        op3_ngram_jaccard_join,
        op4_quality_rules,
        op5_sentencepiece,
        op6_license_scans,
        op7_token_counts,
        op8_ppm_scoring,
        op9_sharding,
        op10_source_mixing,
        op11_periodic_runs,
        op12_cross_tokenizer_alignment,
        op13_toxicity,
    )
}

ORACLE_SQL = {
    "op1_exact_top_k": """
        with v as (
            select row_number() over () as row, vec_id,
                   list_transform(embedding, lambda x: floor(1024 * x::double)) as q
            from embeddings where embedding is not null
        ), s as (
            select a.row, a.vec_id as query_id, b.vec_id,
                   cast(list_dot_product(a.q, b.q) as bigint) as score
            from v a join v b on a.vec_id % 100 = 0 and a.row <> b.row
        ), r as (
            select *, cast(row_number() over (partition by row order by score desc, vec_id) as integer) as rank
            from s
        )
        select query_id, rank, vec_id, score from r where rank <= 10
    """,
}
