"""Align the tokens of two tokenizers over the bytes of each text, and count linked ids corpus-wide.

Both tokenizers cut the same bytes. As sparse matrices, tokens by bytes, A and B give the overlap
links A·Bᵀ. Where tokens of both end at one byte the text is cut into groups; the incidence of
groups and ids gives the links within groups by the same row product. Neither tokenizer looks
past a blank that follows a word, or from a letter to a comma, so texts are cut there into
units, and each distinct unit is worked out once.

Counts of linked id pairs are made chunk by chunk: a chunk of documents hands its distinct pairs
to one sum over the corpus and gets back the totals of just those, so no document's links are
shuffled. Documents wait with their links as places in their chunk's list of pairs.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.numbers import runs
from quayside.llm.tables import whole_text, written

SPACE = "▁"
B_BITS = 16  # of a pair's code; ids of B are below 2 ** 16
CHUNK_CHARS = 1 << 22
KNOWN_UNITS = 400_000
NEW_CHARS = 1 << 18  # of units worked out at once
LONG_UNIT = 512  # longer units are worked out anew in each chunk

# Both tokenizers have a boundary in front of a blank or line end after a character that is none,
# and between a Latin letter and one of these signs.
LETTER, SIGN = "a-zA-ZÀ-ÖØ-öø-ɏ", ",.;:!?"
_CUT = re.compile(rf"(?=[ \n{SIGN}])(?:(?<=\S)(?=[ \n])|(?<=[{LETTER}])(?=[{SIGN}]))")


@dataclass
class Sparse:
    """A matrix in compressed rows: row i holds values[indptr[i]:indptr[i + 1]] in columns indices[…]."""

    indptr: np.ndarray
    indices: np.ndarray
    values: np.ndarray
    columns: int

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.indptr))


def from_entries(row: np.ndarray, column: np.ndarray, value: np.ndarray, rows: int, columns: int) -> Sparse:
    """Entries as rows, those of one place summed up."""
    keys, which = np.unique(row * columns + column, return_inverse=True)
    sums = np.bincount(which, weights=value, minlength=len(keys)).astype(np.int64)
    indptr = np.searchsorted(keys, np.arange(rows + 1) * columns)
    return Sparse(indptr, keys % max(columns, 1), sums, columns)


def transposed(m: Sparse) -> Sparse:
    order = np.argsort(m.indices, kind="stable")
    indptr = np.concatenate([[0], np.cumsum(np.bincount(m.indices, minlength=m.columns))])
    return Sparse(indptr, m.owners()[order], m.values[order], m.rows)


def product(left: Sparse, right: Sparse) -> Sparse:
    """Gustavson's row product: row i is the sum of right's rows k, weighed by left[i, k]."""
    sizes = np.diff(right.indptr)[left.indices]
    at = runs(right.indptr[left.indices], sizes)
    return from_entries(
        np.repeat(left.owners(), sizes),
        right.indices[at],
        np.repeat(left.values, sizes) * right.values[at],
        left.rows,
        right.columns,
    )


def by_bytes(lengths: np.ndarray) -> Sparse:
    """Incidence of tokens and the bytes they cover, for tokens one after another."""
    total = int(lengths.sum())
    indptr = np.concatenate([[0], np.cumsum(lengths)])
    return Sparse(indptr, np.arange(total), np.ones(total, np.int64), total)


def byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary shows each byte: itself if printable, else the next from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class TwoTokenizers:
    """Ids and token bytes of units by a byte-level BPE file (A) and a sentencepiece model (B)."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        with open(path_a, encoding="utf-8") as file:
            parts = json.load(file)
        kind = parts["pre_tokenizer"] or {}
        if parts["normalizer"] or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space"):
            raise ValueError("A must be a byte-level tokenizer without normaliser and added blank")
        letters = byte_letters()
        size = self.a.get_vocab_size()
        tokens = [b""] * size
        for token, i in self.a.get_vocab().items():
            if all(c in letters for c in token):
                tokens[i] = bytes(letters[c] for c in token)
        self.bytes_a = tokens
        model = sentencepiece_model_pb2.ModelProto()
        with open(path_b, "rb") as file:
            model.ParseFromString(file.read())
        normal = model.normalizer_spec
        if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.add_dummy_prefix:
            raise ValueError("B must leave texts as they are and add a blank")
        across = re.compile(f"[^{SPACE}]{SPACE}|\n|[{LETTER}][{SIGN}]")
        if any(across.search(p.piece) for p in model.pieces if p.type == 1):
            raise ValueError("a piece of B reaches across a boundary of units")
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        if len(self.b.encode("\n")) != 2:
            raise ValueError("B must show a line end as one byte")
        self.blank = self.b.piece_to_id(SPACE)
        self.bytes_b = [
            bytes([int(p.piece[3:-1], 16)]) if p.type == 6 else p.piece.replace(SPACE, " ").encode()
            for p in model.pieces
        ]
        if size > 1 << 31 or len(self.bytes_b) > 1 << B_BITS:
            raise ValueError("vocabulary too large")

    def encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of units. B adds a blank by itself, so a unit without one is put after a line end."""
        of_a = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        of_b = self.b.encode([u[1:] if u[0] == " " else "\n" + u for u in units], num_threads=1)
        # B gives nothing for an empty rest; after other units the blank is a piece of its own.
        return of_a, [ids or [self.blank] if u[0] == " " else ids[2:] for u, ids in zip(units, of_b, strict=True)]


class Units:
    """Distinct units with their counts, links and groups, kept while there are not too many."""

    def __init__(self, tokenizers: TwoTokenizers):
        self.tokenizers = tokenizers
        self.length_a = np.array([len(x) for x in tokenizers.bytes_a])
        self.length_b = np.array([len(x) for x in tokenizers.bytes_b])
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        # Of each unit: tokens of A, of B, groups, links, overlaps, whether its bytes are lost.
        self.facts = np.zeros((0, 6), np.int64)
        self.pair_starts, self.pair_sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.codes, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.has_long = False

    def add(self, units: list[str]) -> None:
        some, held = [], 0
        for unit in units:
            if some and held + len(unit) > NEW_CHARS:
                self._add(some)
                some, held = [], 0
            some.append(unit)
            held += len(unit)
            self.has_long |= len(unit) > LONG_UNIT
        if some:
            self._add(some)

    def _add(self, units: list[str]) -> None:
        of_a, of_b = self.tokenizers.encode(units)
        n_a, n_b = (np.array([len(x) for x in ids]) for ids in (of_a, of_b))
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())) for ids, n in ((of_a, n_a), (of_b, n_b)))
        unit_a, unit_b = np.repeat(np.arange(len(units)), n_a), np.repeat(np.arange(len(units)), n_b)
        name_a, name_b = self.tokenizers.bytes_a, self.tokenizers.bytes_b
        lost = np.zeros(len(units), bool)
        for i, (unit, x, y) in enumerate(zip(units, of_a, of_b, strict=True)):
            raw = unit.encode()
            lost[i] = b"".join([name_a[t] for t in x]) != raw or b"".join([name_b[t] for t in y]) != raw
        # A text with such a unit has no tokens, so the unit counts for nothing anywhere.
        keep_a, keep_b = ~lost[unit_a], ~lost[unit_b]
        a, unit_a, b, unit_b = a[keep_a], unit_a[keep_a], b[keep_b], unit_b[keep_b]
        n_a, n_b = np.where(lost, 0, n_a), np.where(lost, 0, n_b)
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        cuts = np.intersect1d(end_a, end_b)
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        overlaps = product(by_bytes(self.length_a[a]), transposed(by_bytes(self.length_b[b])))
        unit_of_group = unit_a[np.searchsorted(end_a, cuts)]
        # Links within groups, by id: how often an id of A and one of B share the group.
        ids_a, at_a = np.unique(a, return_inverse=True)
        ids_b, at_b = np.unique(b, return_inverse=True)
        inside_a = from_entries(group_a, at_a, np.ones(len(a), np.int64), len(cuts), len(ids_a))
        inside_b = from_entries(group_b, at_b, np.ones(len(b), np.int64), len(cuts), len(ids_b))
        # One row for each id of A in each group, so that links of different groups stay apart.
        owner = inside_a.owners()
        row = Sparse(np.arange(len(owner) + 1), owner, inside_a.values, len(cuts))
        shared = product(row, inside_b)
        link_a = inside_a.indices[shared.owners()]
        link_unit = unit_of_group[owner[shared.owners()]]
        code = (ids_a[link_a] << B_BITS) | ids_b[shared.indices] if len(link_a) else np.zeros(0, np.int64)
        links = np.bincount(link_unit, weights=shared.values, minlength=len(units)).astype(np.int64)
        keys, which = np.unique((link_unit << 34) | code, return_inverse=True)
        times = np.bincount(which, weights=shared.values, minlength=len(keys)).astype(np.int64)
        sizes = np.bincount(keys >> 34, minlength=len(units))
        facts = np.stack(
            [
                n_a,
                n_b,
                np.bincount(unit_of_group, minlength=len(units)),
                links,
                np.bincount(unit_a[overlaps.owners()], minlength=len(units)),
                lost,
            ],
            axis=1,
        )
        self.groups += self._shown(a, b, group_a, group_b, unit_of_group, len(units))
        self.known.update(zip(units, range(len(self.known), len(self.known) + len(units)), strict=True))
        self.facts = np.concatenate([self.facts, facts])
        self.pair_starts = np.concatenate([self.pair_starts, np.cumsum(sizes) - sizes + len(self.codes)])
        self.pair_sizes = np.concatenate([self.pair_sizes, sizes])
        self.codes = np.concatenate([self.codes, keys & ((1 << 34) - 1)])
        self.times = np.concatenate([self.times, times])

    @staticmethod
    def _shown(a, b, group_a, group_b, unit_of_group, units: int) -> list[str]:
        n = len(unit_of_group)
        cut_a = np.searchsorted(group_a, np.arange(n + 1)).tolist()
        cut_b = np.searchsorted(group_b, np.arange(n + 1)).tolist()
        text_a, text_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        each = [
            f"{','.join(text_a[cut_a[g] : cut_a[g + 1]])}|{','.join(text_b[cut_b[g] : cut_b[g + 1]])}" for g in range(n)
        ]
        cut = np.searchsorted(unit_of_group, np.arange(units + 1)).tolist()
        return [";".join(each[cut[u] : cut[u + 1]]) for u in range(units)]


@lru_cache(maxsize=2)
def _units(path_a: str, path_b: str) -> Units:
    """One cache of units per Python worker."""
    return Units(TwoTokenizers(path_a, path_b))


def _packed(places: np.ndarray, times: np.ndarray) -> bytes:
    """Rising places and how often each, in few bytes."""
    both = np.concatenate([np.diff(places, prepend=0), times]).astype("<u4")
    return zlib.compress(both.tobytes(), 1)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zlib.decompress(data), "<u4").astype(np.int64)
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


FACTS = "n_a long, n_b long, n_groups long, n_links long, n_overlaps long"
CHUNKED = f"chunk long, doc_id long, {FACTS}, groups_sha256 string, groups string, links binary, code long, docs long"
ARROW = pa.schema(
    [
        *((name, pa.int64()) for name in ("chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps")),
        ("groups_sha256", pa.string()),
        ("groups", pa.string()),
        ("links", pa.binary()),
        ("code", pa.int64()),
        ("docs", pa.int64()),
    ]
)


def _batch(rows: int, **columns) -> pa.RecordBatch:
    arrays = [
        pa.array(columns[field.name], field.type) if field.name in columns else pa.nulls(rows, field.type)
        for field in ARROW
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=ARROW)


def _chunk(number: int, ids: list[int | None], texts: list[str], units: Units, show: bool) -> Iterator[pa.RecordBatch]:
    """Rows of a chunk's documents, and rows of its distinct pairs with how many documents hold each."""
    split = [_CUT.split(" " + text) if text else [] for text in texts]
    flat = list(chain.from_iterable(split))
    if len(units.known) > KNOWN_UNITS or units.has_long:
        units.forget()
    units.add(list(set(flat).difference(units.known)))
    sizes = np.array([len(x) for x in split])
    which = np.fromiter(map(units.known.__getitem__, flat), np.int64, len(flat))
    owner = np.repeat(np.arange(len(texts)), sizes)
    lost = np.bincount(owner, weights=units.facts[which, 5], minlength=len(texts)) > 0
    use = ~lost[owner]
    which, owner = which[use], owner[use]
    facts = [
        np.bincount(owner, weights=units.facts[which, k], minlength=len(texts)).astype(np.int64) for k in range(5)
    ]
    edges = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
    listed = which.tolist()
    groups = [";".join([units.groups[u] for u in listed[a:b]]) for a, b in zip(edges, edges[1:], strict=False)]
    # Distinct units of each document, then distinct pairs.
    span = len(units.known)
    key, n = np.unique(owner * span + which, return_counts=True)
    unit, doc = key % max(span, 1), key // max(span, 1)
    many = units.pair_sizes[unit]
    at = runs(units.pair_starts[unit], many)
    pair = (np.repeat(doc, many) << 34) | units.codes[at]
    pair, place = np.unique(pair, return_inverse=True)
    times = np.bincount(place, weights=np.repeat(n, many) * units.times[at], minlength=len(pair)).astype(np.int64)
    codes, place, docs = np.unique(pair & ((1 << 34) - 1), return_inverse=True, return_counts=True)
    edges = np.searchsorted(pair >> 34, np.arange(len(texts) + 1)).tolist()
    links = [_packed(place[a:b], times[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
    yield _batch(
        len(texts),
        chunk=np.full(len(texts), number),
        doc_id=ids,
        n_a=facts[0],
        n_b=facts[1],
        n_groups=facts[2],
        n_links=facts[3],
        n_overlaps=facts[4],
        groups_sha256=[hashlib.sha256(x.encode()).hexdigest() if x else "" for x in groups],
        links=links,
        **({"groups": groups} if show else {}),
    )
    for first in range(0, len(codes), 100_000):
        part = slice(first, first + 100_000)
        size = len(codes[part])
        yield _batch(size, chunk=np.full(size, number), code=codes[part], docs=docs[part])


def chunks(docs: DataFrame, path_a: str, path_b: str, show: bool = False) -> DataFrame:
    """Documents with their links as places in their chunk's pairs, and each chunk's pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _units(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        ids, texts, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py()
                if texts and held + len(text) > CHUNK_CHARS:
                    yield from _chunk(number, ids, texts, units, show)
                    ids, texts, held, number = [], [], 0, number + 1
                ids.append(doc_id.as_py())
                texts.append(text)
                held += len(text)
        if texts:
            yield from _chunk(number, ids, texts, units, show)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(
        run, CHUNKED
    )


def pair_counts(chunked: DataFrame) -> DataFrame:
    """a, b and code of every linked pair of ids and in how many documents it is linked."""
    sums = chunked.where(F.col("code").isNotNull()).groupBy("code").agg(F.sum("docs").alias("count"))
    return sums.select(
        "code",
        F.shiftright("code", B_BITS).cast("int").alias("a"),
        F.col("code").bitwiseAND((1 << B_BITS) - 1).cast("int").alias("b"),
        "count",
    )


def _totals(key: tuple, docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """n_best and count_sum of a chunk's documents."""
    order = np.argsort(pairs["code"].to_numpy(), kind="stable")
    count = pairs["count"].to_numpy()[order]
    best = pairs["best"].to_numpy()[order]
    n_best, count_sum = [], []
    for data in docs["links"]:
        place, times = _unpacked(data.as_py())
        n_best.append(int((times * best[place]).sum()))
        count_sum.append(int((times * count[place]).sum()))
    kept = docs.drop_columns(["chunk", "links"])
    return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column(
        "count_sum", pa.array(count_sum, pa.int64())
    )


def align(docs: DataFrame, path_a: str, path_b: str, show: bool = False) -> DataFrame:
    """Every document with its tokens, groups, links, overlaps and how its links stand corpus-wide.

    Texts that are null, empty, or whose token bytes differ from a blank and the text (B shows
    U+2581 as a blank) have no tokens: zeros, and '' for the groups. Repeated rows count as often
    as they occur. Of pairs with equal counts all are the best of their id of A. A null id is
    kept; an empty table gives an empty result; other columns are not looked at. `show` adds
    `groups`, the text of which groups_sha256 is the digest.

    The only table sent to all tasks is the highest count of each id of A, as long as A's
    vocabulary at most.
    """
    chunked = written(chunks(docs, path_a, path_b, show), "aligned-chunks")
    counts = written(pair_counts(chunked), "pair-counts")
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    judged = counts.join(F.broadcast(highest), "a").select(
        "code", "count", (F.col("count") == F.col("highest")).cast("int").alias("best")
    )
    wanted = chunked.where(F.col("code").isNotNull()).select(F.col("chunk").alias("home"), "code").join(judged, "code")
    rows = chunked.where(F.col("code").isNull()).drop("code", "docs", *([] if show else ["groups"]))
    shown = ", groups string" if show else ""
    done = rows.groupBy("chunk").cogroup(wanted.groupBy("home")).applyInArrow(
        _totals, f"doc_id long, {FACTS}, groups_sha256 string{shown}, n_best long, count_sum long"
    )
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps"]
    return done.select(*names, *(["groups"] if show else []))
