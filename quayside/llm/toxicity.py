"""Score texts for toxicity with a weighted lexicon that is matched by Aho-Corasick.

Texts are folded first: compatibility forms, case, look-alike letters of other scripts, digits
and signs that stand for letters, and characters without width. The lexicon holds whole words
and beginnings of words. Both are learned from labelled rows: an entry weighs the logarithm of
how much more often it begins (or is) a word of toxic texts than of others. Matches inside an
exception phrase do not count. The weights found are normalised by the text's length, and a
logistic curve, fitted to labelled rows the lexicon has not seen, turns them into a score.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.tables import whole_text, written

HELD_OUT, PARTS = 0, 5
SAMPLE = 20_000  # labelled rows to learn from, those with the smallest hash of their id
ENTRIES = 2_000  # of the lexicon
EXCEPTIONS = 500
SHORTEST, LONGEST = 4, 8  # letters of a beginning of words
LONG_WORD = 40  # longer words are matched, but not learned
LEAST_RATIO = 6.0  # how much likelier in toxic texts an entry is at least
PRIOR = 3.0  # words of clean texts that every entry is taken to have been seen in
LENGTH_PRIOR = 25  # words added to every text, so that a short one is not judged by a single match
RATE_STEPS, MOST_HITS = 8, 30  # cells of the calibration
FLUSH = 1 << 20

# Letters of other scripts that look like Latin ones, and what stands for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "i",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "γ": "y", "ω": "w", "ı": "i", "ɑ": "a", "ɡ": "g", "ł": "i", "ø": "o",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i"}  # only in front of a letter or digit
WIDTHLESS = "­​‌‍⁠﻿"

# "1" stands for i and for l, so all three become one letter.
_FOLDED = str.maketrans(LOOKALIKES | DIGITS | {"l": "i"} | dict.fromkeys(WIDTHLESS, None))
_SIGN = re.compile(r"[@$!|](?=[^\W_])")
_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> list[str]:
    """The folded words of a text."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    if any(sign in text for sign in SIGNS):
        text = _SIGN.sub(lambda found: SIGNS[found[0]], text)
    return _WORD.findall(text.translate(_FOLDED))


@dataclass
class Lexicon:
    """Weights of entries (" word " or " beginning") and phrases within which none counts."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    curve: tuple[float, float, float] = (-math.inf, 0.0, 0.0)

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), None))
        for entry, weight in self.weights.items():
            if entry not in found:
                found.add_word(entry, (len(entry), weight))
        found.make_automaton()
        return found


def hits(automaton, line: str) -> list[tuple[int, float]]:
    """Where in a line of folded words entries begin and what they weigh: the longest at each word."""
    if not len(automaton):
        return []
    longest: dict[int, tuple[int, float]] = {}
    spared: list[tuple[int, int]] = []
    for end, (size, weight) in automaton.iter(line):
        start = end - size + 1
        if weight is None:
            spared.append((start, end))
        elif size > longest.get(start, (0, 0.0))[0]:
            longest[start] = (size, weight)
    if spared:
        # An exception spares the words that begin within it.
        cover = np.zeros(len(line) + 1, np.int32)
        for start, end in spared:
            cover[start] += 1
            cover[end] -= 1
        cover = np.cumsum(cover)
        return [(at, weight) for at, (_, weight) in longest.items() if not cover[at]]
    return [(at, weight) for at, (_, weight) in longest.items()]


def _line(words: list[str]) -> str:
    return f" {' '.join(words)} " if words else ""


def _measured(automaton, text: str) -> tuple[float, int]:
    """Weight found per hundred words, and how many different words of a text are matched.

    A word that is repeated gains with the logarithm of its number only: a line of one word
    over and over says little more than the word.
    """
    words = fold(text)
    if not words:
        return 0.0, 0
    line = _line(words)
    times: Counter[str] = Counter()
    weights = {}
    for at, weight in hits(automaton, line):
        word = line[at + 1 : line.index(" ", at + 1)]
        times[word] += 1
        weights[word] = weight
    total = sum(weights[word] * (1 + math.log(n)) for word, n in times.items())
    return 100 * total / (len(words) + LENGTH_PRIOR), len(times)


def _features(rate: float, n: int) -> tuple[float, float]:
    return round(math.log1p(rate) * RATE_STEPS) / RATE_STEPS, math.log1p(min(n, MOST_HITS))


def _tally(counts: dict, names: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    if counts:
        keys = list(counts)
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32())]
        columns += [pa.array([counts[k][i] for k in keys], pa.int64()) for i in range(len(names) - 2)]
        yield pa.RecordBatch.from_arrays(columns, names=list(names))
        counts.clear()


def _entry_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """entry, toxic, words, docs: distinct words of a text that are or begin with the entry, and texts."""
    names = ("entry", "toxic", "words", "docs")
    counts: dict[tuple[str, int], list[int]] = {}
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            here: Counter[str] = Counter()
            words = {w for w in fold(text) if len(w) <= LONG_WORD}
            for word in words:
                here[f" {word} "] += 1
                for size in range(SHORTEST, min(LONGEST, len(word) - 1) + 1):
                    here[f" {word[:size]}"] += 1
            here[""] = len(words)
            for entry, n in here.items():
                slot = counts.setdefault((entry, toxic), [0, 0])
                slot[0] += n
                slot[1] += 1
            if len(counts) > FLUSH:
                yield from _tally(counts, names)
    yield from _tally(counts, names)


def _phrase_counts(lexicon: Lexicon):
    """phrase, toxic, docs: each matched word, alone and with the words beside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("entry", "toxic", "docs")
        automaton = lexicon.automaton()
        counts: dict[tuple[str, int], list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = fold(text)
                line = _line(words)
                found: set[str] = set()
                for at, _ in hits(automaton, line) if words else ():
                    stop = line.index(" ", at + 1)
                    if stop - at - 1 > LONG_WORD:
                        continue
                    found.add(line[at : stop + 1])
                    if at:
                        before = line.rindex(" ", 0, at)
                        if at - before <= LONG_WORD:
                            found.add(line[before : stop + 1])
                    if stop + 1 < len(line):
                        after = line.index(" ", stop + 1)
                        if after - stop <= LONG_WORD:
                            found.add(line[at : after + 1])
                for phrase in found:
                    counts.setdefault((phrase, toxic), [0])[0] += 1
                if len(counts) > FLUSH:
                    yield from _tally(counts, names)
        yield from _tally(counts, names)

    return run


def _cells(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            found = [_features(*_measured(automaton, text)) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x for x, _ in found], pa.float64()),
                    pa.array([x for _, x in found], pa.float64()),
                    batch.column(1),
                ],
                names=["rate", "hits", "toxic"],
            )

    return run


def fit_curve(cells: Iterable[tuple[float, float, int, int]]) -> tuple[float, float, float]:
    """Logistic curve over counted cells (rate, hits, label, rows), by Newton steps with a small ridge."""
    cells = list(cells)
    if not any(label for _, _, label, _ in cells):
        return (-math.inf, 0.0, 0.0)
    x = np.array([(1.0, rate, n) for rate, n, _, _ in cells])
    y, weight = np.array([c[2] for c in cells], float), np.array([c[3] for c in cells], float)
    ridge = np.diag([1e-3, 1e-2, 1e-2]) * max(1.0, math.sqrt(weight.sum()))
    at = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge @ at
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(bend, slope)
        at = at + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(at.tolist())


def held_out(id_col: str = "doc_id"):
    """Whether labels of a document are kept from learning; those of a null id are."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(PARTS)) == HELD_OUT, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """text, toxic and part (0: for the curve, 1 and 2: for the lexicon) of at most `sample` labelled rows.

    Of an id with several labels the highest counts, of one with several texts the first in
    order; labels without an id or a value, and those held out, are left aside.
    """
    mark = F.xxhash64("doc_id")
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
        .orderBy(mark, "doc_id")
        .limit(sample)
    )
    # `sample` bounds the rows sent, so documents stay where they are.
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min("text").alias("text"))
        .select("text", "toxic", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3)).cast("int").alias("part"))
    )


def learn(rows: DataFrame, exceptions: Iterable[str] = (), entries: int = ENTRIES) -> Lexicon:
    """Lexicon, exceptions and curve from rows of text, toxic and part.

    The driver takes at most `entries` entries, EXCEPTIONS phrases and as many cells as the
    curve has. Without a toxic row the lexicon is empty and every score is 0. `exceptions` are
    phrases given beforehand, such as "trash can".
    """
    given = [_line(fold(phrase)) for phrase in exceptions]
    lexicon = Lexicon(exceptions=[phrase for phrase in given if phrase])
    learning = rows.where("part > 0").select("text", "toxic")
    toxic, clean = F.col("toxic") == 1, F.col("toxic") == 0
    counted = learning.mapInArrow(_entry_counts, "entry string, toxic int, words long, docs long")
    counted = written(
        counted.groupBy("entry").agg(
            F.coalesce(F.sum(F.when(toxic, F.col("words"))), F.lit(0)).alias("toxic_words"),
            F.coalesce(F.sum(F.when(clean, F.col("words"))), F.lit(0)).alias("clean_words"),
            F.coalesce(F.sum(F.when(toxic, F.col("docs"))), F.lit(0)).alias("toxic_docs"),
            F.coalesce(F.sum(F.when(clean, F.col("docs"))), F.lit(0)).alias("clean_docs"),
        ),
        "lexicon-counts",
    )
    totals = counted.where("entry = ''").first()
    if totals is None or not totals.toxic_docs:
        return lexicon
    support = max(2, math.ceil(totals.toxic_docs / 100))
    ratio = ((F.col("toxic_words") + 0.5) / (totals.toxic_words + 1)) / (
        (F.col("clean_words") + PRIOR) / (totals.clean_words + 2 * PRIOR)
    )
    best = (
        counted.where((F.col("entry") != "") & (F.col("toxic_docs") >= support))
        .withColumn("weight", F.log(ratio))
        .where(F.col("weight") >= math.log(LEAST_RATIO))
        .orderBy((F.col("weight") * F.col("toxic_docs")).desc(), "entry")
        .limit(entries)
        .select("entry", "weight")
        .collect()
    )
    weights = {entry: weight for entry, weight in best}
    for entry in sorted(weights, key=len, reverse=True):
        word = entry.strip()
        shorter = (weights.get(f" {word[:size]}") for size in range(SHORTEST, len(entry) - 1))
        if any(w is not None and w >= weights[entry] - 0.5 for w in shorter):
            del weights[entry]  # a beginning says the same
    lexicon.weights = weights
    phrases = learning.mapInArrow(_phrase_counts(lexicon), "entry string, toxic int, docs long")
    share = F.col("toxic_docs") * totals.clean_docs / max(totals.toxic_docs, 1)
    lexicon.exceptions += [
        row.entry
        for row in phrases.groupBy("entry")
        .agg(
            F.coalesce(F.sum(F.when(toxic, F.col("docs"))), F.lit(0)).alias("toxic_docs"),
            F.coalesce(F.sum(F.when(clean, F.col("docs"))), F.lit(0)).alias("clean_docs"),
        )
        .where((F.col("clean_docs") >= 3) & (F.col("clean_docs") >= share))
        .orderBy(F.col("clean_docs").desc(), "entry")
        .limit(EXCEPTIONS)
        .collect()
    ]
    cells = rows.where("part = 0").select("text", "toxic").mapInArrow(_cells(lexicon), "rate double, hits double, toxic int")
    counted_cells = cells.groupBy("rate", "hits", "toxic").agg(F.count("*").alias("n")).orderBy("rate", "hits", "toxic")
    found = [tuple(row) for row in counted_cells.collect()]
    if not any(cell[2] for cell in found):  # too few labels to keep some for the curve
        counted_cells = (
            rows.select("text", "toxic")
            .mapInArrow(_cells(lexicon), "rate double, hits double, toxic int")
            .groupBy("rate", "hits", "toxic")
            .agg(F.count("*").alias("n"))
            .orderBy("rate", "hits", "toxic")
        )
        found = [tuple(row) for row in counted_cells.collect()]
    lexicon.curve = fit_curve(found)
    return lexicon


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, held_out, score, predicted, rate (weight per hundred words) and hits (different words matched) of every row.

    A null text counts as empty; a text without a match, the empty one too, has the score that
    the curve gives to no match. Repeated rows are scored each; a null id is kept and not held
    out. An empty table gives an empty result. Ties of 0.5 are predicted as 1. Other columns
    are not looked at. The lexicon is sent to the tasks; its size is bounded when it is learned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        level, by_rate, by_hits = lexicon.curve
        for batch in batches:
            scores, rates, numbers = [], [], []
            for text in batch.column(2):
                rate, n = _measured(automaton, text.as_py())
                at = _features(rate, n)
                z = level + by_rate * at[0] + by_hits * at[1]
                scores.append(1 / (1 + math.exp(min(-z, 700.0))) if z > -math.inf else 0.0)
                rates.append(rate)
                numbers.append(n)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                    pa.array(rates, pa.float64()),
                    pa.array(numbers, pa.int32()),
                ],
                names=["doc_id", "held_out", "score", "predicted", "rate", "hits"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), whole_text().alias("text")
    )
    return rows.mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int, rate double, hits int"
    )


def judged(docs: DataFrame, labels: DataFrame, exceptions: Iterable[str] = (), sample: int = SAMPLE) -> DataFrame:
    """Every document scored by what the labels that are not held out teach."""
    rows = written(training_rows(docs, labels, sample), "toxicity-sample")
    return score(docs, learn(rows, exceptions))
