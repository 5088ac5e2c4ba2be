"""What the n-gram jaccard join holds at once in a worker, and that it drops rows without moving texts."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows

from quayside.llm import jaccard
from quayside.llm.tables import ARROW_ROWS, BATCH_ROWS, small_batches


def test_a_worker_holds_little_beside_its_sets():
    words = [f"w{i}" for i in range(5000)]
    texts = [" ".join(words[k % 50 :] + [f"own{k}"]) for k in range(100)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(100)), "text": texts})
    tracemalloc.start()
    try:
        *named, counted = jaccard._named([batch])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    sets = sum(n for part in named for n in part.column("n").to_pylist())
    assert peak < 32 * sets  # bytes: 8 in a set, and a copy to sort
    found = [np.frombuffer(counted.column(c)[0].as_py(), np.int64) for c in ("tokens", "counts")]
    every = np.concatenate([np.asarray(s) for _, _, part in jaccard._sets([batch]) for s in part])
    tokens, counts = np.unique(every, return_counts=True)
    assert (found[0].view(np.uint64) == tokens[counts > 1]).all()
    assert (found[1] == counts[counts > 1]).all()


@pytest.mark.parametrize("values", [[], [1], [1, 1], [1, 2], [3, 1, 3, 2, 1, 3], [0, 2**64 - 1, 2**64 - 1]])
def test_repeated_shingles(values):
    sets = [np.array([x], np.uint64) for x in values] + [np.zeros(0, np.uint64)]
    tokens, counts = jaccard._repeated(sets)
    often = sorted(x for x in set(values) if values.count(x) > 1)
    assert tokens.tolist() == often
    assert counts.tolist() == [values.count(x) for x in often]
    assert sets == []


def test_batches_are_small_for_a_while(spark):
    before = spark.conf.get(ARROW_ROWS)
    with pytest.raises(ValueError), small_batches(spark):
        assert spark.conf.get(ARROW_ROWS) == BATCH_ROWS
        raise ValueError
    assert spark.conf.get(ARROW_ROWS) == before
    spark.conf.set(ARROW_ROWS, "7")
    try:
        with small_batches(spark):
            assert spark.conf.get(ARROW_ROWS) == "7"
    finally:
        spark.conf.set(ARROW_ROWS, before)


def test_bits_of_rows(spark):
    numbers = [0, 1, 7, 8, 9, 15, 32767, 32768, 32769, 65535, 2**33 - 1, 2**33, 2**33 + 5, 3 * 2**33 + 40000]
    every = spark.createDataFrame([(x, f"text {x}") for x in [*numbers, 2, 6, 16, 32766, 2**33 + 4, 2**40]], "row long, text string")
    bits = jaccard._bits(spark.createDataFrame([(x,) for x in numbers], "row long"))
    assert rows(jaccard._with_bits(every, bits).select("row", "text")) == [(x, f"text {x}") for x in numbers]
    assert rows(jaccard._with_bits(every, bits.limit(0)).select("row")) == []


def test_rows_are_dropped_without_moving_texts(spark):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "16k")
    try:
        texts = [(i, f"a text of five words {i // 2 * 2}") for i in range(16_000)]
        found = jaccard.one_of_each(spark.createDataFrame(texts, "doc_id long, text string").repartition(2))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan
        assert sorted(x["doc_id"] for x in found.collect()) == list(range(0, 16_000, 2))
    finally:
        spark.conf.set(threshold, before)
