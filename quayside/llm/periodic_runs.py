"""Find periodic runs of words in texts by grammar compression, and cut repeats out of texts.

Pairs that are too rare in their text to lie in a run are cut away first; what is left between
them falls into segments. All segments of a slice of texts are compressed together by Re-Pair
in rounds: in each round the pairs that are more frequent than the pairs they overlap become
nonterminals, until no pair occurs twice, and what is left is paired up into balanced trees.
Every boundary between two words is then the boundary of one nonterminal at one place. The runs
that cross the boundary of a nonterminal are computed once, on one of its occurrences, and
translated to all places where it was derived; the maximal intervals of each period are the
runs. Equal stretches are told by two fingerprints modulo a prime, 62 bits together.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.numbers import mix, runs
from quayside.llm.tables import whole_text

LEAST_PERIODS, LEAST_WORDS = 4, 6
LEAST_PAIRS = 3  # how often each pair of a run occurs in it at least
SLICE_WORDS = 1 << 19
KNOWN_WORDS = 1 << 20
CANDIDATES = 1 << 21  # periods tried at once
PRIME = np.int64(2**31 - 1)
BASES = (1_103_515_245, 1_566_083_941)  # two fixed numbers below the prime


class Powers:
    """Powers of the two bases modulo the prime, as many as were needed so far."""

    def __init__(self):
        self.of = [np.ones(1, np.int64), np.ones(1, np.int64)]

    def upto(self, n: int) -> list[np.ndarray]:
        for k, base in enumerate(BASES):
            powers = self.of[k]
            while len(powers) <= n:
                step = pow(base, len(powers), int(PRIME))
                powers = np.concatenate([powers, powers * np.int64(step) % PRIME])
            self.of[k] = powers
        return self.of


class Prints:
    """Fingerprints of stretches of a sequence of numbers."""

    def __init__(self, ids: np.ndarray, powers: Powers):
        self.n = len(ids)
        self.powers = powers.upto(self.n)
        seeds = (mix(ids.astype(np.uint64)), mix(ids.astype(np.uint64) + np.uint64(1 << 40)))
        self.sums = []
        for seed, power in zip(seeds, self.powers, strict=True):
            terms = (seed >> np.uint64(34)).astype(np.int64) * power[: self.n] % PRIME
            self.sums.append(np.concatenate([np.zeros(1, np.int64), np.cumsum(terms)]))

    def same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray, both: bool = True) -> np.ndarray:
        """Whether the stretches of that size from a and from b (a <= b) are equal."""
        out = np.ones(len(a), bool)
        for sums, power in list(zip(self.sums, self.powers, strict=True))[: 2 if both else 1]:
            left = (sums[a + size] - sums[a]) % PRIME * power[b - a] % PRIME
            out &= left == (sums[b + size] - sums[b]) % PRIME
        return out

    def ahead(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How far the sequences from a and from b agree, up to `most`."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64)
        while len(a) and (low < high).any():
            middle = (low + high + 1) // 2
            good = self.same(a, b, middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low

    def back(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How far the sequences that end before a and before b agree, up to `most`."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64)
        while len(a) and (low < high).any():
            middle = (low + high + 1) // 2
            good = self.same(a - middle, b - middle, middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low


def _times(codes: np.ndarray) -> np.ndarray:
    """How often each code occurs among all."""
    _, which, counts = np.unique(codes, return_inverse=True, return_counts=True)
    return counts[which]


def _pair_codes(group: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of each pair within its group; a clash only makes a pair look more frequent."""
    return mix(mix((left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)) ^ mix(group.astype(np.uint64)))


def segments(ids: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places that runs can cover, and the segment of each: stretches of pairs frequent enough."""
    place, group = np.arange(len(ids)), owner
    linked = owner[1:] == owner[:-1]
    for _ in range(3):
        linked = linked.copy()
        at = np.flatnonzero(linked)
        linked[at] = _times(_pair_codes(group[at], ids[place[at]], ids[place[at + 1]])) >= LEAST_PAIRS
        start = np.append(True, ~linked)[: len(place)]
        number = np.cumsum(start) - 1
        keep = np.bincount(number)[number] >= LEAST_WORDS if len(number) else start
        if keep.all():
            break
        place, group = place[keep], number[keep]
        linked = group[1:] == group[:-1]
    else:
        return place, group
    return place, number


class Grammar:
    """Nonterminals of all segments of a slice and the places where each was derived."""

    def __init__(self, ids: np.ndarray, place: np.ndarray, group: np.ndarray):
        self.known: dict[int, int] = {}
        self.next = int(ids.max()) + 1 if len(ids) else 0
        self.sizes: list[tuple[int, int]] = []
        self.first = self.next
        self.derived: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = np.ones(self.next, np.int64)
        symbol = ids[place].astype(np.int64)
        symbol, place, group = self._repeated(symbol, place, group)
        self._paired(symbol, place, group)

    def _named(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The nonterminals of pairs that begin at these places."""
        keys, which = np.unique((left << 32) | right, return_inverse=True)
        names = np.empty(len(keys), np.int64)
        fresh = []
        for i, key in enumerate(keys.tolist()):
            name = self.known.get(key)
            if name is None:
                name = self.known[key] = self.next
                self.next += 1
                fresh.append(key)
            names[i] = name
        if fresh:
            new = np.array(fresh, np.int64)
            a, b = self.size[new >> 32], self.size[new & 0xFFFFFFFF]
            self.sizes.append((a, b))
            self.size = np.concatenate([self.size, a + b])
        names = names[which]
        self.derived.append((names, place))
        return names

    def _repeated(self, symbol, place, group):
        """Rounds of Re-Pair: pairs that occur twice in their segment, the most frequent first."""
        done = []
        link = np.append(group[1:] == group[:-1], False)[: len(group)]
        while True:
            at = np.flatnonzero(link)
            weight = np.zeros(len(symbol), np.int64)
            if len(at):
                codes = _pair_codes(group[at], symbol[at], symbol[at + 1])
                times = _times(codes)
                often = times >= 2
                link[at[~often]] = False
                at = at[often]
                weight[at] = (times[often] << 32) | (codes[often] >> np.uint64(32)).astype(np.int64)
            idle = ~link & ~np.append(False, link[:-1])[: len(link)]
            if idle.any():
                done.append((symbol[idle], place[idle], group[idle]))
                symbol, place, group, link, weight = (x[~idle] for x in (symbol, place, group, link, weight))
            if not len(symbol):
                break
            # Stretches of one weight are overlapping occurrences of one pair: every other one counts,
            # from the left, if no heavier pair overlaps the stretch there.
            before, after = np.append(0, weight[:-1]), np.append(weight[1:], 0)
            head = weight != before
            start = np.maximum.accumulate(np.where(head, np.arange(len(weight)), 0))
            shift = np.where(before[start] > weight, 1, 0)
            offset = np.arange(len(weight)) - start - shift
            take = link & (offset >= 0) & (offset % 2 == 0) & (after <= weight)
            at = np.flatnonzero(take)
            symbol = symbol.copy()
            symbol[at] = self._named(symbol[at], symbol[at + 1], place[at])
            link[at] = link[at + 1]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            symbol, place, group, link = symbol[keep], place[keep], group[keep], link[keep]
        if not done:
            return symbol, place, group
        symbol, place, group = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(place, kind="stable")
        return symbol[order], place[order], group[order]

    def _paired(self, symbol, place, group) -> None:
        """What is left of each segment as a balanced tree."""
        while len(symbol):
            heads = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            sizes = np.diff(heads, append=len(group))
            keep = np.repeat(sizes > 1, sizes)
            if not keep.any():
                break
            symbol, place, group = symbol[keep], place[keep], group[keep]
            sizes = sizes[sizes > 1]
            number = runs(np.zeros(len(sizes), np.int64), sizes)
            left = (number % 2 == 0) & (number + 1 < np.repeat(sizes, sizes))
            at = np.flatnonzero(left)
            symbol = symbol.copy()
            symbol[at] = self._named(symbol[at], symbol[at + 1], place[at])
            stay = number % 2 == 0
            symbol, place, group = symbol[stay], place[stay], group[stay]

    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each nonterminal the sizes of both sides; of each derivation nonterminal and place."""
        if not self.derived:
            none = np.zeros(0, np.int64)
            return none, none, none, none
        left = np.concatenate([a for a, _ in self.sizes])
        right = np.concatenate([b for _, b in self.sizes])
        names = np.concatenate([n for n, _ in self.derived]) - self.first
        places = np.concatenate([p for _, p in self.derived])
        return left, right, names, places


def crossing(prints: Prints, begin: np.ndarray, left: np.ndarray, right: np.ndarray):
    """Runs across the boundary of each nonterminal, within it: (nonterminal, start, stop, period).

    A run of four periods has two of them on one side of the boundary, so the boundary is next to
    a square of the period there. Of the periods with such a square only those are followed that
    are not multiples of a smaller one that goes on as far.
    """
    found = []
    for side in (right, left):
        most = np.minimum(side // 2, (left + right) // LEAST_PERIODS)
        most[left + right < LEAST_WORDS] = 0
        use = np.flatnonzero(most > 0)
        edges = np.concatenate([[0], np.cumsum(most[use])])
        first = 0
        while first < len(use):
            last = max(first + 1, int(np.searchsorted(edges, edges[first] + CANDIDATES, side="right")) - 1)
            found += _crossing(prints, begin, left, right, use[first:last], most[use[first:last]], side is right)
            first = last
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _crossing(prints, begin, left, right, chosen, most, rightwards):
    who = np.repeat(chosen, most)
    period = runs(np.ones(len(chosen), np.int64), most)
    edge = begin[who] + left[who]
    square = edge if rightwards else edge - 2 * period
    one = np.ones(len(who), np.int64)
    likely = np.flatnonzero(prints.same(square, square + period, one, both=False))
    who, period, square, edge = who[likely], period[likely], square[likely], edge[likely]
    good = prints.same(square, square + period, period)
    who, period, edge = who[good], period[good], edge[good]
    while len(who):
        smallest = np.append(True, who[1:] != who[:-1])
        w, q, b = who[smallest], period[smallest], edge[smallest]
        stop, start = begin[w] + left[w] + right[w], begin[w]
        if rightwards:
            ahead = q + prints.ahead(b, b + q, stop - b - q)
            back = prints.back(b, b + q, b - start)
            within = ahead
        else:
            back = q + prints.back(b - q, b, b - q - start)
            ahead = prints.ahead(b - q, b, stop - b)
            within = back
        long = (ahead + back >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)) & (ahead > 0) & (back > 0)
        yield w[long], (b - back)[long], (b + ahead)[long], q[long]
        # Squares that lie within this stretch have a multiple of its period.
        sizes = np.diff(np.flatnonzero(smallest), append=len(who))
        rest = ~smallest & (2 * period > np.repeat(within, sizes))
        who, period, edge = who[rest], period[rest], edge[rest]


def maximal(owner: np.ndarray, start: np.ndarray, stop: np.ndarray, period: np.ndarray):
    """Intervals of one owner and period that share a period's length made one; smallest periods only."""
    if not len(owner):
        return owner, start, stop, period
    order = np.lexsort((-stop, start, period, owner))
    owner, start, stop, period = owner[order], start[order], stop[order], period[order]
    fresh = np.append(True, (owner[1:] != owner[:-1]) | (period[1:] != period[:-1]))
    # Later groups lie behind all earlier ones, so a running maximum never looks back past its group.
    shift = (np.cumsum(fresh) - 1) * (int(stop.max()) + 1)
    reach = np.maximum.accumulate(stop + shift)
    begins = fresh | np.append(True, start[1:] + shift[1:] + period[1:] > reach[:-1])
    heads = np.flatnonzero(begins)
    owner, start, period = owner[heads], start[heads], period[heads]
    stop = np.maximum.reduceat(stop, heads)
    order = np.lexsort((period, stop, start, owner))
    owner, start, stop, period = owner[order], start[order], stop[order], period[order]
    same = (owner[1:] == owner[:-1]) & (start[1:] == start[:-1]) & (stop[1:] == stop[:-1])
    keep = np.append(True, ~same) & (stop - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period))
    return owner[keep], start[keep], stop[keep], period[keep]


def find_runs(ids: np.ndarray, owner: np.ndarray, powers: Powers | None = None):
    """Runs of every owner's stretch of ids: (owner, start, stop, period), starts from all ids' first.

    `owner` must not fall along the ids. Sorted by owner, start, then stop.
    """
    none = np.zeros(0, np.int64)
    if len(ids) < LEAST_WORDS:
        return none, none, none, none
    place, group = segments(ids, owner)
    if not len(place):
        return none, none, none, none
    # From here on only the segments' words count, laid end to end.
    text, who = ids[place], owner[place]
    grammar = Grammar(text, np.arange(len(text)), group)
    left, right, names, places = grammar.table()
    order = np.argsort(names, kind="stable")
    names, places = names[order], places[order]
    heads = np.searchsorted(names, np.arange(len(left)))
    times = np.diff(heads, append=len(names))
    prints = Prints(text, powers or Powers())
    name, start, stop, period = crossing(prints, places[heads], left, right)
    # One computation for each nonterminal, moved to all its derivations.
    start, stop = start - places[heads[name]], stop - places[heads[name]]
    n = times[name]
    at = places[runs(heads[name], n)]
    start, stop, period = np.repeat(start, n) + at, np.repeat(stop, n) + at, np.repeat(period, n)
    # Segments are kept apart: the words between them are gone here.
    piece, start, stop, period = maximal(group[start], start, stop, period)
    owner_, start_ = who[start], place[start]
    return owner_, start_, start_ + (stop - start), period


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with those of every tenth document's end made periodic, by its id."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "collapsed", "runs"]
KINDS = [pa.int64()] * 6 + [pa.string()] * 3 + [pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))]
SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string,"
    " collapsed_sha256 string, collapsed string, runs array<struct<start: long, length: long, period: long>>"
)


def _described(doc_id: int | None, words: list[bytes], start: list, length: list, period: list) -> tuple:
    found = sorted(zip(start, length, period, strict=True), key=lambda run: (run[0], run[2]))
    best: tuple = (None, None, None)
    for run in found:
        # Greatest exponent, compared exactly; the first of equals has the smallest start and period.
        if best[0] is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    exponent = 1000 * best[1] // best[2] if found else None
    if found:
        drop = bytearray(len(words))
        for first, size, q in found:
            drop[first + q : first + size] = b"\1" * (size - q)
        words = [word for word, gone in zip(words, drop, strict=True) if not gone]
    told = "".join(f"{s},{n},{q}\n" for s, n, q in found).encode()
    kept = b" ".join(words)
    listed = [{"start": s, "length": n, "period": q} for s, n, q in found]
    return (doc_id, len(found), *best, exponent, hashlib.sha256(told).hexdigest(), hashlib.sha256(kept).hexdigest(), kept, listed)


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False, texts: bool = True
) -> DataFrame:
    """Every row with its runs, the one of greatest exponent, and the text without their repeats.

    A run is a stretch of words with smallest period q, at least 4 q and 6 words long, that
    cannot be extended. `collapsed` keeps of each run its first period only, words joined by one
    blank. Null texts count as empty: no run, the four columns of the best one null, an empty
    text. A null id is kept and nothing is planted for it. Repeated rows are scanned each; an
    empty table gives an empty result. Other columns are not looked at. `plant` makes the end of
    every tenth document periodic first; `texts` False leaves out texts and lists.
    """
    kinds = KINDS if texts else KINDS[:8]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        powers = Powers()

        def flush(rows: list[tuple[int | None, list[bytes]]]) -> pa.RecordBatch:
            nonlocal numbers
            if len(numbers) > KNOWN_WORDS:
                numbers = defaultdict(count().__next__)
            sizes = np.array([len(words) for _, words in rows])
            total = int(sizes.sum())
            ids = np.fromiter((numbers[w] for _, words in rows for w in words), np.int64, total)
            owner = np.repeat(np.arange(len(rows)), sizes)
            first = np.cumsum(sizes) - sizes
            who, start, stop, period = find_runs(ids, owner, powers)
            edges = np.searchsorted(who, np.arange(len(rows) + 1)).tolist()
            start, length, period = (start - first[who]).tolist(), (stop - start).tolist(), period.tolist()
            out = []
            for i, (doc_id, words) in enumerate(rows):
                a, b = edges[i], edges[i + 1]
                out.append(_described(doc_id, words, start[a:b], length[a:b], period[a:b])[: len(kinds)])
            columns = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], names=NAMES[: len(kinds)]
            )

        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                # Blanks of bytes.split are those that part words here.
                words = (text.as_py() or "").encode().split()
                if rows and held + len(words) > SLICE_WORDS:
                    yield flush(rows)
                    rows, held = [], 0
                rows.append((doc_id.as_py(), planted(words, doc_id.as_py()) if plant else words))
                held += len(words)
            if rows:
                yield flush(rows)

    schema = SCHEMA if texts else SCHEMA[: SCHEMA.index(", collapsed string")]
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text")).mapInArrow(
        run, schema
    )
