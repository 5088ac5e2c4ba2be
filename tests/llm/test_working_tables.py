"""Working tables go once no later step reads them."""

import corpus_pipeline
import pytest
from conftest import rows

from quayside.llm import jaccard
from quayside.llm.components import components
from quayside.llm.tables import Working
from quayside.session import child_names, shared_dir

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def tables(spark):
    return set(child_names(spark, shared_dir(spark)))


def labels(names):
    return sorted(name.rsplit("-", 1)[0] for name in names)


def some_documents(spark):
    """Two families of near copies, exact copies, texts that share a passage, and one without words."""
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(base[:110] + [f"end{i}"]) for i in range(9)]
    texts += [" ".join(f"c{k}" for k in range(9 * i, 9 * i + 100)) for i in range(5)]
    texts += [" ".join(base[:20] + [f"own{k}x{i}" for i in range(60)]) for k in range(4)]
    found = [(i, text, "en", "ab"[i % 2], len(text or "")) for i, text in enumerate([*texts, texts[0], texts[15], None])]
    return spark.createDataFrame(found, SCHEMA).repartition(3)


@pytest.mark.parametrize("crowd", [32, -1])
def test_the_join_leaves_what_its_result_reads(spark, monkeypatch, crowd):
    monkeypatch.setattr(jaccard, "CROWD", crowd)  # -1: with one more turn
    docs = some_documents(spark)
    before = tables(spark)
    found = jaccard.classes(docs)
    assert labels(tables(spark) - before) == ["compared", "component-ids", "sets"]
    component = dict(rows(found.select("doc_id", "component_id")))
    assert component == {i: 0 if i < 9 or i == 18 else 9 if i < 14 else 15 if i == 19 else i for i in range(21)}
    before = tables(spark)
    one = jaccard.one_of_each(docs)
    assert labels(tables(spark) - before) == ["join-rows", "kept-rows"]
    assert rows(one.select("doc_id")) == [(0,), (9,), (14,), (15,), (16,), (17,), (20,)]


def test_components_leave_the_last_round(spark):
    before, work = tables(spark), Working()
    found = components(spark.createDataFrame([(i, i + 1) for i in range(40)] + [(90, 91)], "a long, b long"), work)
    assert labels(tables(spark) - before) == ["edges"]
    assert rows(found) == [(i, 0) for i in range(41)] + [(90, 90), (91, 90)]
    work.drop_others()
    assert tables(spark) == before


def test_the_pipeline_leaves_one_stage(spark, tmp_path):
    docs = some_documents(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    before = tables(spark)
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert labels(tables(spark) - before).count("stage") == 1
    assert {x["doc_id"] for x in found.collect()} <= {0, 9, 14, 15, 16, 17}
