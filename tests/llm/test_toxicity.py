"""Toxicity: folding, matching, exceptions, and accuracy on labels kept from learning."""

import math

import pytest
from llm.conftest import local

from quayside.llm import toxicity
from quayside.llm.queries import QUERIES


@pytest.mark.parametrize(
    "odd, plain",
    [
        ("ІDIОТ", "IDIOT"),
        ("1d10t", "idiot"),
        ("$tup!d", "stupid"),
        ("l0ser 10ser", "loser ioser"),
        ("ｓｔｕｐｉｄ", "stupid"),
        ("stu​p­id", "stupid"),
        ("p@th3tic!!", "pathetic"),
    ],
)
def test_folding(odd, plain):
    assert toxicity.fold(odd) == toxicity.fold(plain)


def test_folding_keeps_other_letters():
    assert toxicity.fold("Été naïve THE!! a | b $$$ 2-6") == ["été", "naïve", "the", "a", "b", "2", "6"]
    assert toxicity.fold("") == []


def hit_words(lexicon, text):
    line = toxicity._line(toxicity.fold(text))
    return [line[at:].split()[0] for at, _ in sorted(toxicity.hits(lexicon.automaton(), line))] if line else []


def test_longest_entry_at_each_word_and_exceptions():
    lexicon = toxicity.Lexicon({" trash ": 3.0, " tras": 1.0, " mor": 2.0}, [" trash can "])
    assert hit_words(lexicon, "Trash, trashy TRASH can moron more trash") == ["trash", "trashy", "moron", "more", "trash"]
    assert hit_words(lexicon, "trash can") == []
    assert hit_words(lexicon, "can trash") == ["trash"]
    assert dict(toxicity.hits(lexicon.automaton(), " trash trashy "))[0] == 3.0
    assert hit_words(lexicon, "") == []


def test_repeats_and_length_dampen():
    automaton = toxicity.Lexicon({" moron ": 2.0}).automaton()
    once, many = toxicity._measured(automaton, "moron"), toxicity._measured(automaton, "moron " * 50)
    assert once == (200 / 26, 1) and many[1] == 1
    assert many[0] < toxicity._measured(automaton, " ".join("moron " + c for c in "abcdefgh" * 6))[0] * 2 < 50 * once[0]
    assert toxicity._measured(automaton, "moron " + "x " * 500)[0] < 0.5


def test_curve_separates_and_stays_finite():
    cells = [(0.0, 0.0, 0, 900), (0.0, 0.0, 1, 10), (2.0, 1.1, 1, 90), (2.0, 1.1, 0, 1)]
    a, b, c = toxicity.fit_curve(cells)
    assert 1 / (1 + math.exp(-a)) < 0.1 and 1 / (1 + math.exp(-(a + 2 * b + 1.1 * c))) > 0.7
    assert toxicity.fit_curve([(0.0, 0.0, 0, 5)])[0] == -math.inf
    assert toxicity.fit_curve([])[0] == -math.inf


def test_every_row_is_scored(tables):
    docs, labels = tables
    found = local(toxicity.judged(docs, labels))
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r["doc_id"]) for r in local(docs))
    for r in found:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        import zlib

        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_held_out_labels_and_other_columns_do_not_matter(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    want = {r["doc_id"]: r["score"] for r in local(toxicity.judged(docs, labels))}
    from pyspark.sql import functions as F

    other = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    found = toxicity.judged(docs.withColumns({"lang": F.lit("x"), "source": F.lit(None)}), other)
    assert {r["doc_id"]: r["score"] for r in local(found)} == want


def test_without_toxic_labels_nothing_is_toxic(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    assert {r["score"] for r in local(toxicity.judged(docs, labels.where("toxic = 0")))} == {0.0}


def test_accuracy_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = QUERIES["op13_toxicity"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    rows = [r for r in local(found) if r["held_out"]]
    toxic, clean = ([r for r in rows if r["toxic"] == k] for k in (1, 0))
    assert sum(r["predicted"] for r in toxic) >= 0.9 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.01 * len(clean)


def test_learned_exceptions(spark):
    toxic = [(f"you are trash {i} really moron x{i}", 1, 1 + i % 2) for i in range(30)]
    clean = [(f"put it into the trash can number n{i} " + "some quiet words " * 30, 0, 1 + i % 2) for i in range(40)]
    rows = spark.createDataFrame(toxic + clean, "text string, toxic int, part int")
    lexicon = toxicity.learn(rows)
    assert " moron " in lexicon.weights or " moro" in lexicon.weights
    assert "trash" not in hit_words(lexicon, "a trash can")
    assert hit_words(lexicon, "you are trash") != []
