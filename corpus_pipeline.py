"""Documents through five stages: quality, near duplicates, secrets, mixing, encoding."""

from __future__ import annotations

import public_tokenizers

from quayside.llm import jaccard, mixing, pieces, quality, secret_scan
from quayside.llm.queries import MODEL
from quayside.llm.tables import read
from quayside.session import apply_settings, delete_path, new_dir


def keep_good(spark, docs, sf_dir):
    """Documents that pass the quality rules, with cutoffs from this input's labels."""
    return quality.kept_documents(docs, read(spark, sf_dir, "labels"))


def keep_one_of_each(spark, docs, sf_dir):
    """One document of each class of similar texts."""
    return jaccard.one_of_each(docs)


def hide_secrets(spark, docs, sf_dir):
    """All documents, secrets replaced."""
    return secret_scan.redacted(docs)


def mix_sources(spark, docs, sf_dir):
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def encode_text(spark, docs, sf_dir):
    """Documents with the ids of their pieces and the text that these decode to."""
    path = public_tokenizers.path(MODEL)
    return pieces.decode(pieces.encode(docs, path), path)


STAGES = [
    ("quality rules", keep_good),
    ("n-gram jaccard join", keep_one_of_each),
    ("secret scans", hide_secrets),
    ("mixing sources", mix_sources),
    ("sentencepiece", encode_text),
]

# Similarity classes and piece encoding are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over documents, each written and read again; the one before is then deleted."""
    apply_settings(spark)
    docs, before = read(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        path = new_dir(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    return docs
