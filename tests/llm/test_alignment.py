"""Alignment of two tokenizers against whole texts encoded by the libraries and linked pair by pair."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from llm.conftest import in_order, local
from tokenizers import Tokenizer

from quayside.llm import alignment
from quayside.llm.queries import BYTE_LEVEL, MODEL, QUERIES

PATH_A, PATH_B = public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(MODEL)


def tokens(text, a, b):
    """Ids and bytes of both, or nothing where bytes are lost."""
    letters = alignment.byte_letters()
    raw = (" " + text).encode()
    of_a = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    of_b = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        of_b.append((i, bytes([int(piece[3:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    if not text or b"".join(x for _, x in of_a) != raw or b"".join(x for _, x in of_b) != raw:
        return [], []
    return of_a, of_b


def groups_of(of_a, of_b):
    out, i, j, at_a, at_b = [], 0, 0, 0, 0
    while i < len(of_a):
        group = ([], [])
        while True:
            if at_a <= at_b:
                group[0].append(of_a[i][0])
                at_a += len(of_a[i][1])
                i += 1
            else:
                group[1].append(of_b[j][0])
                at_b += len(of_b[j][1])
                j += 1
            if at_a == at_b:
                break
        out.append(group)
    return out


def overlaps_of(of_a, of_b):
    ends = np.cumsum([len(x) for _, x in of_b])
    at, n = 0, 0
    for _, x in of_a:
        n += int(np.searchsorted(ends, at + len(x)) - np.searchsorted(ends, at, side="right")) + 1
        at += len(x)
    return n


def expected(rows):
    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    both = [tokens(r["text"] or "", a, b) for r in rows]
    groups = [groups_of(*x) for x in both]
    links = [Counter((x, y) for g in found for x in g[0] for y in g[1]) for found in groups]
    counts = Counter(pair for found in links for pair in found)
    highest = Counter()
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    out = []
    for r, x, found, pairs in zip(rows, both, groups, links, strict=True):
        told = ";".join(f"{','.join(map(str, g[0]))}|{','.join(map(str, g[1]))}" for g in found)
        out.append(
            (
                r["doc_id"],
                len(x[0]),
                len(x[1]),
                len(found),
                sum(pairs.values()),
                sum(n for pair, n in pairs.items() if counts[pair] == highest[pair[0]]),
                sum(n * counts[pair] for pair, n in pairs.items()),
                hashlib.sha256(told.encode()).hexdigest() if told else "",
                overlaps_of(*x),
                told,
            )
        )
    return out


def test_align(tables):
    docs, _ = tables
    got = [tuple(r.values()) for r in local(alignment.align(docs, PATH_A, PATH_B, show=True))]
    assert in_order(got) == in_order(expected(local(docs)))


def test_chunks_and_forgetting_change_nothing(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = in_order(expected(local(docs)))
    units = alignment.Units(alignment.TwoTokenizers(PATH_A, PATH_B))
    monkeypatch.setattr(alignment, "KNOWN_UNITS", 500)
    rows, counts = [], Counter()
    for number, part in enumerate(np.array_split(np.array([(r["doc_id"], r["text"]) for r in local(docs)], object), 9)):
        made = list(alignment._chunk(number, [x[0] for x in part], [x[1] or "" for x in part], units, True))
        rows += made[0].to_pylist()
        for batch in made[1:]:
            counts.update(dict(zip(batch["code"].to_pylist(), batch["docs"].to_pylist(), strict=True)))
    assert in_order([(r["doc_id"], r["groups"]) for r in rows]) == in_order([(r[0], r[-1]) for r in want])
    assert len(counts) > 1000


def test_query_has_the_columns(spark, sf_dir):
    found = QUERIES["op12_cross_tokenizer_alignment"](spark, sf_dir)
    assert found.columns[:8] == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_product_is_that_of_dense_matrices():
    rnd = np.random.default_rng(1)
    for _ in range(50):
        n, m, k = rnd.integers(1, 9, 3)
        x, y = rnd.integers(0, 3, (n, m)), rnd.integers(0, 3, (m, k))

        def sparse(dense):
            row, column = np.nonzero(dense)
            return alignment.from_entries(row, column, dense[row, column], *dense.shape)

        found = alignment.product(sparse(x), sparse(y))
        dense = np.zeros((n, k), int)
        dense[found.owners(), found.indices] = found.values
        assert (dense == x @ y).all()
        turned = alignment.transposed(sparse(x))
        assert (turned.owners().tolist(), turned.indices.tolist()) == tuple(c.tolist() for c in np.nonzero(x.T))
