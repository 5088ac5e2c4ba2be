"""Scoring by tables too large to send: what moves for terms is per block of texts, not per text."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from conftest import rows

from quayside.llm import ppm


def exchanged(frame):
    """Rows that the exchanges of a finished query wrote."""

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        own = node.metrics().apply("shuffleRecordsWritten").value() if name == "Exchange" else 0
        return own + sum(walk(node.children().apply(i)) for i in range(node.children().size()))

    return walk(frame._jdf.queryExecution().executedPlan())


def test_terms_move_once_a_block(spark):
    text = " ".join(f"word{i}" for i in range(300))
    docs = spark.createDataFrame([(i, f"{text} own{i}") for i in range(200)], "doc_id long, text string").repartition(2)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")  # as with tables too large to send
    try:
        found = ppm.score(docs, sent=0)
        got = rows(found)
    finally:
        spark.conf.set(threshold, before)
    # Each text has over 300 words and over 300 runs, nearly all of them shared.
    assert 200 < exchanged(found) < 200 * 100
    for a, b in zip(got, rows(ppm.score(docs)), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-12)


@pytest.mark.parametrize("limit", [1, 200, 1 << 20])
def test_blocks_score_as_the_whole(monkeypatch, limit):
    texts = ["", "", "one two", "one two", "One  TWO three", "x" * 300, "é中 \U0001f600 ", *(f"a{i} b{i % 3}" * 9 for i in range(30))]
    ids = [None if i == 4 else i % 35 for i in range(len(texts))]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(texts), pa.array([i % 2 == 0 for i in range(len(texts))])],
        names=["doc_id", "text", "held_out"],
    )
    every = pa.Table.from_batches(ppm._asked(ppm._blocks([batch]))).to_pylist()
    codes = {kind: np.array([x["code"] for x in every if x["kind"] == kind]) for kind in (ppm.WORDS, ppm.RUNS)}
    # Every third word is unknown.
    values = {kind: dict(zip(c[c % 3 > 0] if kind == ppm.WORDS else c, np.sqrt(np.arange(1, len(c) + 1)))) for kind, c in codes.items()}
    tables = [ppm._in_order(np.array(list(v)), np.array(list(v.values()))) for v in (values[ppm.WORDS], values[ppm.RUNS])]
    want = pa.Table.from_batches(ppm._scored(batch, *tables)).to_pylist()
    assert not any(np.isnan(x["score"]) for x in want)

    monkeypatch.setattr(ppm, "BLOCK_BYTES", limit)
    monkeypatch.setattr(ppm, "SLICE_BYTES", min(limit, 100))
    blocks = pa.Table.from_batches(ppm._blocks([batch]))
    of_each = blocks["block"].to_pylist()
    assert of_each == sorted(of_each) and (of_each[-1] > 0) == (limit <= 200)
    asked = [x for b in ppm._asked(iter(blocks.to_batches())) for x in b.to_pylist()]
    assert len(asked) == len({tuple(x.values()) for x in asked})
    got = []
    for block in dict.fromkeys(of_each):
        found = [x | {"value": values[x["kind"]][x["code"]]} for x in asked if x["block"] == block and x["code"] in values[x["kind"]]]
        parts = blocks.filter(pc.equal(blocks["block"], block))
        got += ppm._answered(parts, pa.Table.from_pylist(found)).to_pylist()
    assert got == want
