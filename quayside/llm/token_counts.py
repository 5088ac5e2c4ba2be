"""Token totals for every context limit from one exact histogram of document lengths."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.tables import whole_text, written

RUN = 1024  # neighbouring lengths whose sums are made together


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("byte-bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def lengths(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """n_tokens of every whole text; null counts as empty, with 0 tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(ranks_path, pattern)
        for batch in batches:
            counts = [len(encoding.encode_ordinary(text.as_py())) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], names=["n_tokens"])

    return docs.select(whole_text(text_col).alias("text")).mapInArrow(run, "n_tokens long")


def histogram(counts: DataFrame) -> DataFrame:
    """context_limit and n_docs: how many documents have just that many tokens."""
    return counts.groupBy(F.col("n_tokens").alias("context_limit")).agg(F.count("*").alias("n_docs"))


def totals(counts: DataFrame) -> DataFrame:
    """One row per occurring length, taken as a context limit.

    n_docs of just that length; docs_over and tokens_over: documents longer than the limit and
    their tokens; docs_within and tokens_within: the others; truncated_total: tokens left when
    every document is cut at the limit; share_within: the part of documents that fit, so the
    smallest limit with a share of q or more is the q-quantile of lengths. For a limit between
    two occurring lengths a < limit < b: docs and tokens over are those of a, and the truncated
    total is tokens_within + limit * docs_over, both of a. Equal documents count as often as
    they occur. An empty table gives an empty result.

    Sums run from the longest length down, first over runs of neighbouring lengths and then
    within each, so no task holds all lengths. The histogram, which is read twice, is written
    first, so that documents are encoded once. `at_limits` and `quantiles` answer from the result.
    """
    lengths_ = written(histogram(counts), "lengths").withColumns(
        {"run": F.floor(F.col("context_limit") / RUN), "tokens": F.col("context_limit") * F.col("n_docs")}
    )
    runs = lengths_.groupBy("run").agg(F.sum("n_docs").alias("run_docs"), F.sum("tokens").alias("run_tokens"))
    later = Window.orderBy(F.col("run").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = runs.select(
        "run",
        F.coalesce(F.sum("run_docs").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("run_tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("run_docs").over(everything).alias("all_docs"),
        F.sum("run_tokens").over(everything).alias("all_tokens"),
    )
    longer = (
        Window.partitionBy("run").orderBy(F.col("context_limit").desc()).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        lengths_.join(runs, "run")
        .withColumn("docs_over", F.col("later_docs") + F.coalesce(F.sum("n_docs").over(longer), F.lit(0)))
        .withColumn("tokens_over", F.col("later_tokens") + F.coalesce(F.sum("tokens").over(longer), F.lit(0)))
        .select(
            "context_limit",
            "n_docs",
            "docs_over",
            "tokens_over",
            (F.col("all_docs") - F.col("docs_over")).alias("docs_within"),
            (F.col("all_tokens") - F.col("tokens_over")).alias("tokens_within"),
            (F.col("all_tokens") - F.col("tokens_over") + F.col("context_limit") * F.col("docs_over")).alias(
                "truncated_total"
            ),
            ((F.col("all_docs") - F.col("docs_over")) / F.col("all_docs")).alias("share_within"),
        )
    )


def at_limits(table: DataFrame, limits: list[int]) -> DataFrame:
    """Of the result of `totals`, one row for each limit asked for, whether such a length occurs or not.

    context_limit, docs_over, docs_within, tokens_within and truncated_total as in `totals`.
    Repeated limits are answered once, limits below 0 are refused. An empty table gives no rows.
    """
    limits = sorted(set(limits))
    if limits and limits[0] < 0:
        raise ValueError("a context limit cannot be negative")
    if not limits:
        limits_schema = "context_limit long, docs_over long, docs_within long, tokens_within long, truncated_total long"
        return table.sparkSession.createDataFrame([], limits_schema)
    reached = F.struct("docs_over", "docs_within", "tokens_within")
    # One aggregate a limit, combined in each task: the longest length that is within it.
    found = table.agg(
        F.max(F.col("docs_over") + F.col("docs_within")).alias("n"),
        *(
            F.max_by(reached, F.when(F.col("context_limit") <= limit, F.col("context_limit"))).alias(f"_{i}")
            for i, limit in enumerate(limits)
        ),
    ).where("n is not null")
    rows = []
    for i, limit in enumerate(limits):
        over, within, tokens = (
            F.coalesce(F.col(f"_{i}.{name}"), default)
            for name, default in (("docs_over", F.col("n")), ("docs_within", F.lit(0)), ("tokens_within", F.lit(0)))
        )
        rows.append(
            F.struct(
                F.lit(limit).cast("long").alias("context_limit"),
                over.alias("docs_over"),
                within.alias("docs_within"),
                tokens.alias("tokens_within"),
                (tokens + F.lit(limit) * over).alias("truncated_total"),
            )
        )
    return found.select(F.inline(F.array(*rows)))


def quantiles(table: DataFrame, shares: list[float]) -> DataFrame:
    """Of the result of `totals`, for each share the smallest length that this part of all documents fits in.

    share and context_limit. Repeated shares are answered once; shares must lie in (0, 1]. An
    empty table gives no rows.
    """
    shares = sorted(set(shares))
    if any(not 0 < q <= 1 for q in shares):
        raise ValueError("a share lies in (0, 1]")
    if not shares:
        return table.sparkSession.createDataFrame([], "share double, context_limit long")
    first = (
        F.min(F.when(F.col("share_within") >= q, F.col("context_limit"))).alias(f"_{i}") for i, q in enumerate(shares)
    )
    found = table.agg(*first).where("_0 is not null")
    rows = (
        F.struct(F.lit(float(q)).alias("share"), F.col(f"_{i}").alias("context_limit")) for i, q in enumerate(shares)
    )
    return found.select(F.inline(F.array(*rows)))
