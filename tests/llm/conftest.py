"""Tables the operators of this package are tried on."""

import pytest
from conftest import SF_DIR

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, size int"
AWKWARD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n\x0b\x0c\r ", "en", "a", 1),
    (3, "one two", "en", "a", 7),
    (3, "one two", "en", "a", 7),
    (None, "One TWO", None, None, 7),
    (None, None, None, None, 7),
    (4, "ends in a blank ", "en", "a", 1),
    (5, "  begins with two and  has odd \u0085 blanks \x1c here\n  and there \n", "en", "a", 1),
    (6, "shows ▁ itself", "en", "a", 1),
    (7, "<|endoftext|> </s> <0x41> <unk> isn't 12345678 \U0001f600\U0001f600 中文字符 é́ ​", "zh", "b", 1),
    (8, "a " * 4000 + "b", "en", "b", 1),
    (9, "x y z " * 700 + "end", "en", "b", 1),
    (11, "ab cd ef gh ij " * 30 + "\n\n same\n same\n x \U0001f600 é", "en", "c", 1),
    (12, "x" * 5000 + " " * 3000 + "é中" * 700 + " \x00 y", "fr", "d", 1),
    (13, "!!! " * 5 + "??? " * 6, "en", "d", 1),
    (20, "one two three four five six seven eight nine ten eleven", "en", "d", 1),
    (30, "w " * 3 + "one two three four", "en", "d", 1),
    *((k, " ".join(f"w{i * i % 23}" for i in range(40 + k)), "en", "d", 1) for k in range(40, 90)),
]


@pytest.fixture(scope="module", params=["given", "awkward", "empty"])
def tables(request, spark):
    """documents and labels: given ones, odd ones with columns of clashing names, and none."""
    if request.param == "given":
        return tuple(spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    rows = [(*r, 5, 6) for r in AWKWARD] if request.param == "awkward" else []
    marks = [(r[0], k % 2, k % 2, "text") for k, r in enumerate(AWKWARD)] + [(3, 0, None, ""), (3, 1, 0, "")]
    labels = marks if request.param == "awkward" else []
    return (
        spark.createDataFrame(rows, SCHEMA).repartition(3),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string"),
    )


def local(df):
    return [r.asDict() for r in df.collect()]


def in_order(found):
    return sorted(found, key=lambda r: [(v is not None, str(v)) for v in r])
