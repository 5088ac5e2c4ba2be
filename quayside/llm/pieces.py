"""SentencePiece BPE over columns: encoding by vectorised merge rounds, and decoding.

Distinct words of a batch are laid end to end in one array of symbols. Each round finds every
word's pair of best rank, merges its occurrences from the left, and closes the gaps; words
without a pair left are done. The library only opens the model file.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.numbers import Lookup, runs
from quayside.llm.tables import whole_text

SPACE = "▁"
LONG_WORD = 256  # longer words merge one by one through a heap, in n log n steps
CACHED_WORDS = 250_000
BATCH_TEXT = 1 << 21  # characters laid out at once
NEVER = np.int32(2**31 - 1)


class Pieces:
    """Encoder and decoder of one model file, of the kind checked in `__init__`."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        normal, trainer = model.normalizer_spec, model.trainer_spec
        if (
            trainer.model_type != 2
            or not trainer.byte_fallback
            or trainer.treat_whitespace_as_suffix
            or normal.precompiled_charsmap
            or normal.remove_extra_whitespaces
            or not (normal.add_dummy_prefix and normal.escape_whitespaces)
        ):
            raise ValueError("a BPE model with byte fallback and unchanged text is needed")
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.end = library.eos_id()
        size = len(library)
        names = [library.id_to_piece(i) for i in range(size)]
        special = [library.is_control(i) or library.is_unknown(i) or library.is_byte(i) for i in range(size)]
        ids = {name: i for i, name in enumerate(names) if not special[i]}
        if any(library.is_unused(i) for i in range(size)) or any(p.type == 4 for p in model.pieces):
            raise ValueError("unused and user-defined pieces are not supported")
        if any(re.search(f"[^{SPACE}]{SPACE}", name) for name in ids):
            raise ValueError("a piece reaches into the next word")
        # Equal scores share a rank: the leftmost pair then goes first.
        scores = np.array([library.get_score(i) for i in range(size)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.of_char = np.full(0x110000, -1, np.int32)
        for name, i in ids.items():
            if len(name) == 1:
                self.of_char[ord(name)] = i
        if any(self.of_char[ord(c)] < 0 for name in ids for c in name):
            raise ValueError("a piece holds a character that is no piece")
        pairs = {
            (ids[name[:k]] << 32) | ids[name[k:]]: i
            for name, i in ids.items()
            for k in range(1, len(name))
            if name[:k] in ids and name[k:] in ids
        }
        self.pairs = pairs
        self.merged = Lookup(
            np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs)), np.int32(-1)
        )
        self.of_byte = np.zeros(256, np.int32)
        self.byte_of = np.full(size, -1, np.int16)
        shown = []
        for i, name in enumerate(names):
            if library.is_byte(i):
                self.of_byte[int(name[3:-1], 16)] = i
                self.byte_of[i] = int(name[3:-1], 16)
                shown.append(bytes([self.byte_of[i]]))
            elif library.is_control(i):
                shown.append(b"")
            elif library.is_unknown(i):
                shown.append(" ⁇ ".encode())
            else:
                shown.append(name.replace(SPACE, " ").encode())
        self.lengths = np.array([len(x) for x in shown])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(shown), np.uint8)
        self.leads = np.array([name.startswith(SPACE) and not special[i] for i, name in enumerate(names)])
        self.control = np.array([library.is_control(i) for i in range(size)])
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.word_starts = self.word_lengths = np.zeros(0, np.int64)
        self.word_ids = np.zeros(0, np.int32)

    def encode(self, texts: list[str], end: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has."""
        find = re.compile(f"{SPACE}+[^{SPACE}]*").findall
        split = [find(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.known) > CACHED_WORDS:
            self._forget()
        flat = list(chain.from_iterable(split))
        new = list(set(flat).difference(self.known))
        for first in range(0, len(new), CACHED_WORDS):
            some = new[first : first + CACHED_WORDS]
            ids, lengths = self._words(some)
            self.word_starts = np.concatenate([self.word_starts, np.cumsum(lengths) - lengths + len(self.word_ids)])
            self.word_lengths = np.concatenate([self.word_lengths, lengths])
            self.word_ids = np.concatenate([self.word_ids, ids])
            self.known.update(zip(some, range(len(self.known), len(self.known) + len(some)), strict=True))
        counts = np.array([len(parts) for parts in split], np.int64)
        which = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        ids = self.word_ids[runs(self.word_starts[which], self.word_lengths[which])]
        ends = np.concatenate([[0], np.cumsum(self.word_lengths[which])])[np.cumsum(counts)] if len(counts) else counts
        totals = np.diff(ends, prepend=0)
        if end:
            ids = np.insert(ids, ends, self.end)
            totals = totals + 1
        return ids, totals

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words and how many each has."""
        sizes = np.array([len(w) for w in words])
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        start = np.cumsum(sizes) - sizes
        done = []  # (word, first character, symbol)
        for w in np.flatnonzero(sizes > LONG_WORD):
            place, symbols = self._long(self.of_char[points[start[w] : start[w] + sizes[w]]])
            done.append((np.full(len(place), w), place + start[w], symbols))
        short = np.flatnonzero(sizes <= LONG_WORD)
        place = runs(start[short], sizes[short])
        done += self._rounds(np.repeat(short, sizes[short]), place, self.of_char[points[place]])
        word, place, symbol = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(place, kind="stable")
        word, place, symbol = word[order], place[order], symbol[order]
        unknown = symbol < 0
        if unknown.any():
            spelled = [list(chr(c).encode()) for c in points[place[unknown]]]
            times = np.ones(len(symbol), np.int64)
            times[unknown] = [len(x) for x in spelled]
            filled = np.repeat(unknown, times)
            word, symbol = np.repeat(word, times), np.repeat(symbol, times)
            symbol[filled] = self.of_byte[np.array([b for x in spelled for b in x])]
        return symbol.astype(np.int32), np.bincount(word, minlength=len(words))

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What pairs of symbols merge to, and its rank."""
        to = self.merged.get((left.astype(np.int64) << 32) | right)
        to[(left < 0) | (right < 0)] = -1
        return to, np.where(to < 0, NEVER, self.rank[to])

    def _rounds(self, word: np.ndarray, place: np.ndarray, symbol: np.ndarray) -> list[tuple]:
        done = []
        while len(word):
            n = len(word)
            last = np.append(word[1:] != word[:-1], True)
            to, rank = np.full(n, -1, np.int32), np.full(n, NEVER)
            to[:-1], rank[:-1] = self._pair(symbol[:-1], symbol[1:])
            rank[last] = NEVER
            heads = np.flatnonzero(np.append(True, last[:-1]))
            sizes = np.diff(heads, append=n)
            best = np.minimum.reduceat(rank, heads)
            busy = np.repeat(best < NEVER, sizes)
            if not busy.all():
                done.append((word[~busy], place[~busy], symbol[~busy]))
                word, place, symbol, to, rank, last = (x[busy] for x in (word, place, symbol, to, rank, last))
                best, sizes = best[best < NEVER], sizes[best < NEVER]
                n = len(word)
                if not n:
                    break
            least = np.repeat(best, sizes)
            hit = rank == least
            # Of overlapping occurrences every other one counts, from the left.
            where = np.arange(n)
            head = hit & ~np.append(False, hit[:-1])
            since = where - np.maximum.accumulate(np.where(head, where, 0))
            at = np.flatnonzero(hit & (since % 2 == 0))
            at = self._undisturbed(at, word, symbol, to, least, last)
            symbol = symbol.copy()
            symbol[at] = to[at]
            keep = np.ones(n, bool)
            keep[at + 1] = False
            word, place, symbol = word[keep], place[keep], symbol[keep]
        return done or [(word, place, symbol)]

    def _undisturbed(self, at, word, symbol, to, least, last) -> np.ndarray:
        """Occurrences up to the first in each word whose merging brings forth a pair that goes first."""
        owner = word[at]
        several = np.append(owner[1:] == owner[:-1], False) | np.append(False, owner[1:] == owner[:-1])
        if not several.any():
            return at
        here = at[several]
        n = len(word)
        new = to[here]
        before = np.maximum(here - 1, 0)
        left = symbol[before]
        joined = np.append(False, here[1:] == here[:-1] + 2)
        left = np.where(joined, np.append(-1, new[:-1]), left)
        _, left_rank = self._pair(left, new)
        left_rank[(here == 0) | (word[before] != word[here])] = NEVER
        after = np.minimum(here + 2, n - 1)
        _, right_rank = self._pair(new, symbol[after])
        right_rank[(here + 2 >= n) | (word[after] != word[here])] = NEVER
        stop = here[np.minimum(left_rank, right_rank) <= least[here]]
        if not len(stop):
            return at
        stop_word, first = np.unique(word[stop], return_index=True)
        limit = np.full(len(at), n)
        found = np.searchsorted(stop_word, owner)
        found[found == len(stop_word)] = 0
        same = stop_word[found] == owner
        limit[same] = stop[first][found[same]]
        return at[at <= limit]

    def _long(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First characters and symbols of one long word."""
        symbol = symbols.tolist()
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, pairs = self.rank, self.pairs
        queue: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else n
            if j < n and symbol[i] >= 0 and symbol[j] >= 0:
                to = pairs.get((symbol[i] << 32) | symbol[j])
                if to is not None:
                    heapq.heappush(queue, (int(rank[to]), i, symbol[i], symbol[j]))

        for i in range(n):
            offer(i)
        gone = [False] * n
        while queue:
            _, i, left, right = heapq.heappop(queue)
            if gone[i] or symbol[i] != left or after[i] >= n or symbol[after[i]] != right:
                continue
            j = after[i]
            symbol[i] = pairs[(left << 32) | right]
            gone[j] = True
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        place = np.flatnonzero(~np.array(gone, bool))
        return place, np.array(symbol, np.int32)[place]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of runs of ids: unreadable bytes become U+FFFD, the blank put in front goes."""
        lengths = self.lengths[ids]
        flat = self.bytes[runs(self.starts[ids], lengths)]
        edges = np.concatenate([[0], np.cumsum(lengths)])
        stops = np.cumsum(counts)
        out = []
        for first, stop in zip((stops - counts).tolist(), stops.tolist(), strict=True):
            lead = first
            while lead < stop and self.control[ids[lead]]:
                lead += 1
            skip = int(lead < stop and self.leads[ids[lead]])
            raw = flat[edges[first] + skip : edges[stop]].tobytes()
            try:
                out.append(raw.decode())
            except UnicodeDecodeError:
                out.append(self._mended(ids[first:stop], skip))
        return out

    def _mended(self, ids: np.ndarray, skip: int) -> str:
        """Runs of byte pieces decoded by themselves, each stray byte as one U+FFFD."""
        parts, raw = [], bytearray()

        def flush() -> None:
            at = 0
            while at < len(raw):
                for size in (1, 2, 3, 4):
                    try:
                        parts.append(raw[at : at + size].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    parts.append("�")
                    size = 1
                at += size
            raw.clear()

        for i in ids.tolist():
            if self.byte_of[i] >= 0:
                raw.append(int(self.byte_of[i]))
            else:
                flush()
                parts.append(self.bytes[self.starts[i] : self.starts[i] + self.lengths[i]].tobytes().decode())
        flush()
        return "".join(parts)[skip:]


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """One model per Python worker."""
    return Pieces(path)


def _with_column(frame: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in frame.schema.fields if f.name != name] + [T.StructField(name, kind)])


def _slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of about `most` in sum, at least a row each."""
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def encode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids", end: bool = True) -> DataFrame:
    """Adds the ids of each whole text, exactly as the library gives them, as array<int>.

    A null text counts as empty and has the end id only. Other columns stay; one already named
    like `ids_col` is replaced. Rows keep their number, repeated or not.
    """
    schema = _with_column(docs, ids_col, T.ArrayType(T.IntegerType(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        for batch in batches:
            column = batch.column(batch.schema.names.index(text_col))
            sizes = np.array(pa.compute.fill_null(pa.compute.utf8_length(column), 0).to_numpy(False))
            for start, stop in _slices(sizes, BATCH_TEXT):
                part = batch.slice(start, stop - start)
                texts = [t or "" for t in column.slice(start, stop - start).to_pylist()]
                ids, counts = model.encode(texts, end)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                yield _replaced(part, schema, ids_col, pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())))

    return docs.mapInArrow(run, schema)


def decode(frame: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Adds the text of each array of ids as the library's decode gives it; null ids give ''."""
    schema = _with_column(frame, text_col, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        for batch in batches:
            column = batch.column(batch.schema.names.index(ids_col))
            counts = np.array(pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(False))
            for start, stop in _slices(counts, BATCH_TEXT):
                part = column.slice(start, stop - start)
                ids = part.flatten().to_numpy(False)
                texts = model.decode(ids, counts[start:stop])
                yield _replaced(batch.slice(start, stop - start), schema, text_col, pa.array(texts, pa.string()))

    return frame.mapInArrow(run, schema)


def _replaced(batch: pa.RecordBatch, schema: T.StructType, name: str, values: pa.Array) -> pa.RecordBatch:
    names = batch.schema.names
    arrays = [values if f.name == name else batch.column(names.index(f.name)) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row, by encoding and decoding."""
    coded = encode(docs.select("doc_id", whole_text().alias("text")), model_path).drop("text")
    decoded = decode(coded, model_path)
    joined = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return decoded.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
