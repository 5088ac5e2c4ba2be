"""Quality rules with thresholds whose false rejections are bounded with confidence.

Every rule is a score that grows with badness. Labelled good documents are the holdout: for a
stratum and cutoffs of all rules, the good documents above any of them are a binomial sample of
the false rejections of all rules together. Cutoffs are safe if the exact binomial tail says that
a risk over the limit would have shown so few only with a small chance. One part of the good
documents and the bad ones lay down in which order the rules' cutoffs are made stricter; the
other part tests this path step by step, and the first step that is not safe ends it
(fixed-sequence testing). So neither the risk nor the chance is split among rules; the chance is
shared among strata only (Bonferroni), those with too few good documents standing as one pool.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.tables import whole_text, words, written
from quayside.session import small_frame

GRAM = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of the words
RISK = 0.005  # of a good document of a stratum, by all rules together
CONFIDENCE = 0.95  # that no limit is broken anywhere
# Part of the labelled bad documents that a cutoff must catch to be worth its risk.
LEAST_CATCH = 0.02
ORDERING = 4  # one good document in so many orders the path, the others test it
CUTOFFS = tuple(round(0.95 - 0.05 * i, 2) for i in range(19)) + (0.04, 0.03, 0.02)


def _repeat_words(grams: Column) -> Column:
    """Words covered by windows that occur twice or more, from the hashes of all windows."""
    placed = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

    def repeated(pairs: Column) -> Column:
        twice = F.filter(
            pairs,
            lambda p, i: (p["g"] == F.get(pairs, i - 1)["g"]) | (p["g"] == F.get(pairs, i + 1)["g"]),
        )
        return F.array_sort(F.transform(twice, lambda p: p["i"]))

    def covered(places: Column) -> Column:
        steps = F.transform(
            places, lambda at, i: F.least(F.lit(GRAM), F.coalesce(F.get(places, i + 1) - at, F.lit(GRAM)))
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    # `transform` over a single value names it: an inner lambda that refers to an expression
    # would work it out anew for each element.
    named = F.transform(F.array(placed), repeated)
    return F.transform(named, covered)[0]


def features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines.

    A null text counts as empty: all are 0 (n_lines: 1). Windows are compared by 64-bit hashes
    of their words within one document.
    """
    text = whole_text(text_col)
    word = lambda i, k: F.get(F.col("words_"), i + k)
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    grams = F.transform(
        F.when(F.size("words_") >= GRAM, F.sequence(F.lit(0), F.size("words_") - GRAM)).otherwise(
            F.array().cast("array<int>")
        ),
        lambda i: F.xxhash64(*(word(i, k) for k in range(GRAM))),
    )
    return (
        docs.withColumn("words_", words(text))
        .withColumns({"grams_": grams, "lines_": lines})
        .withColumns(
            {
                "n_words": F.size("words_").cast("long"),
                "word_chars": F.length(F.array_join("words_", "")).cast("long"),
                "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
                "n_lines": F.size("lines_").cast("long"),
                "n_dup_lines": (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long"),
                "n_repeat_words": F.when(
                    F.size(F.array_distinct("grams_")) == F.size("grams_"), F.lit(0).cast("long")
                ).otherwise(_repeat_words(F.col("grams_"))),
                "upper_words": F.size(
                    F.filter("words_", lambda w: (w == F.upper(w)) & (w != F.lower(w)))
                ).cast("long"),
            }
        )
        .drop("words_", "grams_", "lines_")
    )


def rules() -> dict[str, Column]:
    """Scores from 0 to 1 that grow with badness."""
    part = lambda a, b: F.when(F.col(b) > 0, F.least(F.lit(1.0), F.col(a) / F.col(b))).otherwise(0.0)
    return {
        "symbols": part("n_symbols", "word_chars"),
        "dup_lines": part("n_dup_lines", "n_lines"),
        "repeats": part("n_repeat_words", "n_words"),
        "capitals": part("upper_words", "n_words"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def tail(errors: Column, trials: Column, risk: float) -> Column:
    """P(X <= errors) of a binomial X of so many trials, in exact terms summed by logarithms."""
    odds = F.log(F.lit(risk / (1 - risk)))
    start = F.struct(
        (trials * F.log(F.lit(1 - risk))).alias("term"), F.exp(trials * F.log(F.lit(1 - risk))).alias("sum")
    )

    def add(state: Column, i: Column) -> Column:
        term = state["term"] + F.log((trials - i + 1) / i) + odds
        return F.struct(term.alias("term"), (state["sum"] + F.exp(term)).alias("sum"))

    steps = F.when(errors > 0, F.sequence(F.lit(1).cast("long"), errors)).otherwise(F.array().cast("array<long>"))
    return F.aggregate(steps, start, add, lambda state: F.least(F.lit(1.0), state["sum"]))


def least_good(risk: float = RISK, confidence: float = CONFIDENCE, groups: int = 1) -> int:
    """Tested good documents without which no cutoff can be safe, even if none is rejected."""
    return math.ceil(math.log((1 - confidence) / groups) / math.log(1 - risk))


def _own_strata(good: dict[str, int], risk: float, confidence: float) -> list[str]:
    """Strata with enough good documents for cutoffs of their own, beside one pool of the others."""
    order = sorted(good, key=lambda name: (-good[name], name))
    fits = [m for m in range(len(order) + 1) if m == 0 or good[order[m - 1]] >= least_good(risk, confidence, m + 1)]
    return order[: fits[-1]]


def _path(names: list[str], good: dict, bad: dict) -> list[tuple[str, int]]:
    """Rules and steps in the order in which they are tested: what catches most for its harm first.

    `good` and `bad` hold documents by (rule, step); a step of a rule follows its milder ones.
    """
    all_good, all_bad = (sum(n for (name, _), n in x.items() if name == names[0]) for x in (good, bad))
    at, path = dict.fromkeys(names, 0), []
    while True:
        best = None
        for name in names:
            harm = caught = 0
            for step in range(at[name], len(CUTOFFS)):
                more = bad.get((name, step), 0)
                harm, caught = harm + good.get((name, step), 0), caught + more
                # Milder cutoffs that catch as many bad documents are preferred.
                if more and caught >= LEAST_CATCH * all_bad and caught * all_good > 10 * harm * all_bad:
                    best = min(best or (math.inf,), (harm / caught, -caught, name, step))
        if best is None:
            return path
        name, step = best[2:]
        path += [(name, k) for k in range(at[name], step + 1)]
        at[name] = step + 1


def thresholds(scored: DataFrame, labels: DataFrame, risk: float = RISK, confidence: float = CONFIDENCE) -> DataFrame:
    """stratum, rule and cutoff for each rule and stratum that has a safe and useful cutoff.

    `scored` has doc_id, stratum and the columns of `features`; `labels` has doc_id and
    quality (1: good). Rows without an id, or with other labels, take no part; several labels
    of a document count as good if any does. Without labels there is no cutoff at all. Good
    documents above a cutoff are its false rejections; what the base rules reject counts too.
    Bad documents that the base rules reject need no cutoff and do not count.

    Strata with too few good documents, or none, share the cutoffs of a pool: of all such
    strata together or, if these are too few as well, of all strata. The limit then holds for
    a document of the pool, not for each of its strata.
    """
    spark = scored.sparkSession
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("quality").alias("quality"))
    )
    scores = rules()
    # Only cutoffs below the score count it as rejected: the first of them is the rule's step.
    below = lambda score: F.size(F.filter(F.array(*map(F.lit, CUTOFFS)), lambda c: score <= c))
    part = F.when(F.col("quality") == 0, "bad").when(F.pmod(F.xxhash64("doc_id"), F.lit(ORDERING)) == 0, "order").otherwise("test")
    labelled = written(
        scored.join(known, "doc_id")
        .where((F.col("quality") == 1) | ~base_failed())
        .select("stratum", part.alias("part"), *(below(score).alias(name) for name, score in scores.items())),
        "quality-labelled",
    )
    tested = labelled.where("part = 'test'")
    enough = least_good(risk, confidence)
    large = tested.groupBy("stratum").agg(F.count("*").alias("n")).where(F.col("n") >= enough)
    own = _own_strata({x["stratum"]: x["n"] for x in large.collect()}, risk, confidence)
    groups = len(own) + 1
    stands_alone = F.col("stratum").isin(own) if own else F.lit(False)
    pooled = tested.where(~stands_alone).count() >= least_good(risk, confidence, groups)
    # The pool is named by null, which is no stratum.
    in_groups = F.array(F.when(stands_alone, F.col("stratum")), *([] if pooled else [F.lit(None).cast("string")]))
    grouped = labelled.withColumn("group", F.explode(F.array_distinct(in_groups)))
    named = F.array(*(F.struct(F.lit(name).alias("rule"), F.col(name).alias("step")) for name in scores))
    seen: dict = {}
    for x in (
        grouped.where("part <> 'test'")
        .select("group", "part", F.explode(named).alias("x"))
        .groupBy("group", "part", "x.rule", "x.step")
        .count()
        .collect()
    ):  # at most one row per group, part, rule and cutoff
        seen.setdefault(x["group"], {"order": {}, "bad": {}})[x["part"]][x["rule"], x["step"]] = x["count"]
    paths = {group: _path(list(scores), x["order"], x["bad"]) for group, x in seen.items()}
    paths = {group: path for group, path in paths.items() if path}
    if not paths:
        return spark.createDataFrame([], "stratum string, rule string, cutoff double")
    places = [(group, name, k, i) for group, path in paths.items() for i, (name, k) in enumerate(path)]
    moves = small_frame(spark, places, "group string, rule string, step int, place int")
    order = moves.groupBy(F.col("group").alias("of")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.struct("rule", "step"), "place"))).alias("places")
    )
    # A document is rejected from the first place on at which any rule rejects it.
    first = F.array_min(F.transform(named, lambda x: F.col("places")[x]))
    wrong = (
        grouped.where("part = 'test'")
        .join(F.broadcast(order), F.col("group").eqNullSafe(F.col("of")))  # a row a group
        .groupBy("group", first.alias("place"))
        .agg(F.count("*").alias("wrong"))
    )
    so_far = Window.partitionBy("group").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    trials = wrong.groupBy(F.col("group").alias("of")).agg(F.sum("wrong").alias("trials"))
    hits = wrong.select(F.col("group").alias("in"), F.col("place").alias("hit"), "wrong")
    safe = (
        moves.join(trials, F.col("group").eqNullSafe(F.col("of")))
        .join(hits, F.col("group").eqNullSafe(F.col("in")) & (F.col("place") == F.col("hit")), "left")
        .withColumn("errors", F.sum(F.coalesce("wrong", F.lit(0))).over(so_far).cast("long"))
        .withColumn("chance", tail(F.col("errors"), F.col("trials"), risk))
        .withColumn("all_safe", F.min(F.col("chance") <= (1 - confidence) / groups).over(so_far))
        .where("all_safe")
        .groupBy("group", "rule")
        .agg(F.max("step").alias("step"))
    )
    found = []
    for x in safe.collect():  # a row a group and rule
        bad = {k: n for (name, k), n in seen[x["group"]]["bad"].items() if name == x["rule"]}
        useful = [k for k in bad if k <= x["step"]]
        if useful and sum(bad[k] for k in useful) >= LEAST_CATCH * sum(bad.values()):
            found.append((x["group"], x["rule"], CUTOFFS[max(useful)]))
    cutoffs = small_frame(spark, found, "group string, rule string, cutoff double")
    strata = scored.select("stratum").distinct().withColumn("of", F.when(stands_alone, F.col("stratum")))
    return strata.join(F.broadcast(cutoffs), F.col("of").eqNullSafe(F.col("group"))).select("stratum", "rule", "cutoff")


def judged(scored: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Adds base_failed and kept to rows with stratum and features."""
    per_stratum = cutoffs.groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs_")
    )
    over = F.lit(False)
    for name, score in rules().items():
        over = over | F.coalesce(score > F.col("cutoffs_")[name], F.lit(False))
    return (
        scored.withColumn("base_failed", base_failed())
        .join(written(per_stratum, "cutoffs"), "stratum", "left")
        .withColumn("kept", ~F.col("base_failed") & ~over)
        .drop("cutoffs_")
    )


def stratum(column: str = "lang") -> Column:
    """The language, with null as a stratum of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every row; rows stay as often as they occur."""
    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", stratum().alias("stratum"))
    scored = written(features(asked).drop("text"), "quality-features")
    return judged(scored, thresholds(scored, labels)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with the columns of `docs`."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    asked = docs.select(
        F.struct(*names).alias("kept_row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text"),
        stratum().alias("stratum"),
    )
    scored = written(features(asked).drop("text"), "quality-features", texts=True)
    cutoffs = thresholds(scored.drop("kept_row"), labels)
    return judged(scored, cutoffs).where("kept").select("kept_row.*")
