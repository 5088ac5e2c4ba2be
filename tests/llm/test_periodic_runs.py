"""Periodic runs against every period tried at every place."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from llm.conftest import in_order, local

from quayside.llm import periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def all_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def expected(doc_id, text, plant):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = all_runs(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    told = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    return (
        doc_id,
        len(found),
        *best,
        1000 * best[1] // best[2] if found else None,
        hashlib.sha256(told.encode()).hexdigest(),
        hashlib.sha256(kept.encode()).hexdigest(),
        kept,
        found,
    )


def test_scan(tables):
    docs, _ = tables
    got = [
        (*list(r.values())[:9], [(x["start"], x["length"], x["period"]) for x in r["runs"]])
        for r in local(periodic_runs.scan(docs, plant=True))
    ]
    want = [expected(r["doc_id"], r["text"], True) for r in local(docs)]
    assert in_order(got) == in_order(want)


def test_given_documents_hold_runs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert periodic_runs.scan(docs, plant=True, texts=False).where("n_runs > 0").count() > 10


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_words(seed):
    rnd = random.Random(seed)
    for _ in range(60):
        texts = []
        for _ in range(rnd.randint(1, 10)):
            letters, words = rnd.choice([1, 2, 3, 5, 50]), []
            for _ in range(rnd.randint(0, 8)):
                base = [rnd.randrange(letters) for _ in range(rnd.randint(1, 12))]
                words += (base * 10)[: rnd.randint(0, len(base) * 9)]
                words += [rnd.randrange(letters) for _ in range(rnd.choice([0, 0, 20]))]
            texts.append(words)
        ids = np.array([w for t in texts for w in t], np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        first = np.cumsum([0] + [len(t) for t in texts])
        who, start, stop, period = periodic_runs.find_runs(ids, owner)
        for i, words in enumerate(texts):
            mine = who == i
            got = sorted(zip((start - first[i])[mine], (stop - start)[mine], period[mine], strict=True))
            assert got == all_runs(words)


def test_long_runs_take_few_steps():
    for words in ([0] * 300_000, [0, 1] * 150_000, list(range(5_000)) * 60):
        who, start, stop, period = periodic_runs.find_runs(np.array(words), np.zeros(len(words), np.int64))
        assert (start.tolist(), stop.tolist()) == ([0], [300_000])


def test_grammar_is_shared_and_derives_the_text():
    words = np.array([1, 2, 3, 4, 5, 6, 7] * 12, np.int64)
    group = np.zeros(len(words), np.int64)
    grammar = periodic_runs.Grammar(words, np.arange(len(words)), group)
    left, right, names, places = grammar.table()
    # Every boundary between words belongs to one derivation, and far fewer nonterminals do.
    assert sorted((places + left[names]).tolist()) == list(range(1, len(words)))
    assert len(left) < len(words) / 3
    for name in range(len(left)):
        at = places[names == name]
        texts = {tuple(words[p : p + left[name] + right[name]]) for p in at}
        assert len(texts) == 1
