"""Mix sources to target shares of words by systematic sampling.

Each source is to give a target number of words, so each of its documents is expected
target / source size times. Running sums of these expectations, plus one random offset for the
source, pass whole numbers as they grow; a document is taken once for each number passed on it.
Documents stand in the order of size classes, so the words taken follow the target closely.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.tables import whole_text, word_count, written

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
CLASSES_PER_DOUBLING = 16
LEAST_BLOCK = 256


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Adds target to a frame of source and source_size, one row per source.

    Sources in code point order, null last, weigh as the weights repeat. All sizes are shared
    by weight; a target stops at `most` times its source's size, and what is over is shared
    again among the others. The end of that resharing is worked out directly: with sources in
    the order of cap / weight, those before some point stop at their caps, and the rest share
    what is left.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "turn")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("turn") - 1) % len(weights) + 1).cast("int"))
    return (
        sizes.withColumn("turn", F.row_number().over(everything))
        .withColumn("weight", weight.cast("double"))
        .withColumn("cap", F.col("source_size").cast("double") * most)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(whole).cast("double"))
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("capped")) / F.sum("weight").over(onward))
        .withColumn("fits", F.col("level") <= F.col("ratio"))
        .withColumn("chosen", F.min_by("level", F.when(F.col("fits"), F.struct("ratio", "turn"))).over(whole))
        .withColumn(
            "target",
            F.least(F.col("cap"), F.coalesce(F.col("chosen") * F.col("weight"), F.col("cap"))),
        )
        .select("source", "source_size", "target")
    )


def copies(
    docs: DataFrame,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """row, doc_id, source, size, source_size, target and copies of every document.

    `row` numbers the rows; columns named in `carry` are kept. A null text has no words and a
    null source is a source of its own. Documents without words may be copied but add none.
    Equal seeds and equal rows give equal copies; rows that are equal throughout are
    exchangeable. An empty table gives an empty result.

    Ranks within a source come from blocks: a size class of a source, spread over as many
    blocks as keep each near the square root of all rows, so that neither a large source nor
    many texts of one length meet in one task.
    """
    text = whole_text(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).alias("source"),
        word_count(text).alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col), text).alias("spread"),
        *carry,
    ).withColumns(
        {
            "row": F.monotonically_increasing_id(),
            "source_key": F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")),
            "size_class": F.floor(F.log2(F.col("size") + 1.0) * CLASSES_PER_DOUBLING).cast("int"),
        }
    )
    rows = written(rows, "mix-rows", texts=bool(carry))
    classes = written(
        rows.groupBy("source_key", "source", "size_class").agg(
            F.count("*").alias("class_rows"), F.sum("size").alias("class_size")
        ),
        "mix-classes",
    )
    total = classes.agg(F.coalesce(F.sum("class_rows"), F.lit(0))).first()[0]
    per_block = max(LEAST_BLOCK, math.isqrt(total))
    by_source = written(
        targets(classes.groupBy("source").agg(F.sum("class_size").alias("source_size"))), "mix-targets"
    )
    spreads = classes.select(
        "source_key", "size_class", F.ceil(F.col("class_rows") / per_block).alias("spreads")
    )
    placed = rows.join(spreads, ["source_key", "size_class"]).withColumn(
        "block", F.pmod(F.col("spread"), F.col("spreads"))
    )
    block = ["source_key", "size_class", "block"]
    before = (
        Window.partitionBy("source_key")
        .orderBy("size_class", "block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        placed.groupBy(*block)
        .agg(F.count("*").alias("n"))
        .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .drop("n")
    )
    shares = by_source.select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("source_key"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("each"),
    )
    in_block = Window.partitionBy(*block).orderBy("size", "spread", "row")
    start = F.pmod(F.xxhash64(F.lit(seed), F.col("source_key")), F.lit(1 << 30)) / float(1 << 30)
    passed = lambda rank: F.floor(F.col("each") * rank + start)
    return (
        placed.withColumn("place", F.row_number().over(in_block))
        .join(offsets, block)
        .join(shares, "source_key")
        .withColumn("rank", F.col("offset") + F.col("place"))
        .withColumn("copies", passed(F.col("rank")) - passed(F.col("rank") - 1))
        .withColumn("copies", F.least(F.col("copies"), F.lit(MOST_COPIES)))
        .select("row", "doc_id", "source", "size", "source_size", "target", "copies", *carry)
    )


def mixed(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of `docs`."""
    names = docs.columns
    kept = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("kept_row"), "doc_id", "text", "source")
    taken = copies(kept, seed, carry=("kept_row",)).where("copies > 0")
    return taken.select(
        "kept_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    ).select("kept_row.*")
