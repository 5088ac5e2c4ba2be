"""Score texts by prediction by partial matching over bytes, next to a word unigram base.

Counts of words and of byte runs (a context and the byte after it) are gathered from the training
documents. The runs form a context trie: each lower order is the sum over the first byte. A byte
is predicted in its longest context; if it was never seen there the context is escaped from,
with d / (n + d) for n bytes seen, d of them different, and the next shorter context predicts
among what is left after the bytes already ruled out (symbol exclusion), at last evenly. The code
length of a run depends on nothing else, so each run that occurs anywhere gets its log
probability once, and a text's score is the sum over its runs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.tables import whole_text, written
from quayside.llm.word_hashes import slices, text_bytes, word_hashes

ORDER = 3  # bytes of context; texts begin as after that many zero bytes
END = 256  # the symbol after the last byte
SYMBOL_BITS = 9
HELD_OUT, PARTS = 2, 7
# Entries of both tables together that tasks are sent whole, 16 bytes each: 128 MB a worker at most.
SENT_ENTRIES = 8_000_000
FLUSH = 1 << 23  # runs counted together within a task
SLICE_BYTES = 1 << 20  # of texts that are worked on at once; a worker holds some 60 bytes for each
# Beyond SENT_ENTRIES: texts whose terms are asked for together, in bytes; each text weighs ROW_BYTES more.
BLOCK_BYTES, ROW_BYTES = 1 << 25, 32
WORDS, RUNS = 0, 1


def _runs(raw: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the runs of every text, its end among them, and how many each has."""
    sizes = np.diff(edges)
    total = len(raw) + len(sizes)
    last = edges[1:] + np.arange(len(sizes))
    symbols = np.full(total, END, np.int64)
    inner = np.ones(total, bool)
    inner[last] = False
    symbols[inner] = raw
    begin = np.repeat(last - sizes, sizes + 1)
    place = np.arange(total) - begin
    context = np.zeros(total, np.int64)
    for back in range(ORDER, 0, -1):
        earlier = np.zeros(total, np.int64)
        earlier[back:] = symbols[:-back] if total > back else 0
        context = (context << 8) | np.where(place >= back, earlier, 0)
    return (context << SYMBOL_BITS) | symbols, sizes + 1


def _word_codes(raw: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes, counts = word_hashes(raw, edges)
    return hashes.view(np.int64), counts


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind, code and count in training texts: of all runs, and of the words of training texts."""
    waiting: dict[int, list] = {WORDS: [], RUNS: []}

    def flush(kind: int) -> pa.RecordBatch:
        codes = np.concatenate([c for c, _ in waiting[kind]])
        counts = np.concatenate([n for _, n in waiting[kind]])
        waiting[kind].clear()
        distinct, which = np.unique(codes, return_inverse=True)
        sums = np.bincount(which, weights=counts, minlength=len(distinct)).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(distinct), kind, np.int32)), pa.array(distinct), pa.array(sums)],
            names=["kind", "code", "count"],
        )

    def add(kind: int, codes: np.ndarray, weight: int) -> None:
        distinct, counts = np.unique(codes, return_counts=True)
        waiting[kind].append((distinct, counts * weight))

    for batch in batches:
        raw, edges = text_bytes(batch.column(0))
        train = ~np.array(batch.column(1).to_numpy(False), bool)
        for first, last in slices(edges, SLICE_BYTES):
            part = edges[first : last + 1]
            body, cuts = raw[part[0] : part[-1]], part - part[0]
            words, counts = _word_codes(body, cuts)
            add(WORDS, words[np.repeat(train[first:last], counts)], 1)
            runs, counts = _runs(body, cuts)
            use = np.repeat(train[first:last], counts)
            add(RUNS, runs[use], 1)
            add(RUNS, runs[~use], 0)
            for kind, parts in waiting.items():
                if sum(len(c) for c, _ in parts) > FLUSH:
                    yield flush(kind)
    for kind, parts in waiting.items():
        if parts:
            yield flush(kind)


def _stats(context: np.ndarray, count: np.ndarray):
    """For rows in order of context: where each context's rows begin, n and d of each row's context."""
    heads = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(context) else np.zeros(0, int)
    sizes = np.diff(heads, append=len(context))
    n = np.repeat(np.add.reduceat(count, heads) if len(heads) else count, sizes)
    d = np.repeat(np.add.reduceat(count > 0, heads) if len(heads) else count, sizes)
    return n, d


def log_probabilities(order1: np.ndarray):
    """For the runs whose contexts end in the same byte: their log10 probabilities.

    `order1` holds the counts of all pairs (a byte, the symbol after it), so orders 1, 0 and the
    even spread over all symbols are known to every group; longer contexts are all within it.
    """
    order0 = order1.sum(axis=0)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        code = table["code"].to_numpy()
        count = table["count"].to_numpy().astype(np.float64)
        symbol = code & (2**SYMBOL_BITS - 1)
        context = code >> SYMBOL_BITS
        log = np.zeros(len(code))
        open_ = np.ones(len(code), bool)  # not predicted yet
        # Of the next longer context of each row: what its symbols weigh here, and how many they are.
        ruled_n = ruled_d = np.zeros(len(code))
        longer = None
        for order in range(ORDER, -2, -1):
            if order == -1:
                here, n, d = np.ones(len(code)), np.full(len(code), 257.0), np.zeros(len(code))
                ruled = np.count_nonzero(order0)
                log[open_] -= np.log10(257.0 - ruled)
                break
            mask = (1 << (8 * order)) - 1
            if order > 1:
                own = context & mask
                key_ = (own << SYMBOL_BITS) | symbol
                distinct, which = np.unique(key_, return_inverse=True)
                sums = np.bincount(which, weights=count, minlength=len(distinct))
                n_, d_ = _stats(distinct >> SYMBOL_BITS, sums)
                here, n, d = sums[which], n_[which], d_[which]
            else:
                last = context & 255
                grid = order1[last] if order == 1 else np.broadcast_to(order0, (len(code), END + 1))
                here = grid[np.arange(len(code)), symbol].astype(np.float64)
                n, d = grid.sum(axis=1).astype(np.float64), np.count_nonzero(grid, axis=1).astype(np.float64)
            if longer is not None:
                # Symbols seen in the longer context are ruled out here: their counts here, summed once each.
                long_context, long_here = longer
                if order == 0:
                    seen = order1[context & 255] > 0
                    ruled_n, ruled_d = (seen * order0).sum(axis=1), seen.sum(axis=1)
                else:
                    pair = np.unique((long_context << SYMBOL_BITS) | symbol, return_index=True)[1]
                    weigh = np.where(long_here[pair] > 0, here[pair], 0.0)
                    _, slot = np.unique(long_context, return_inverse=True)
                    ruled_n = np.bincount(slot[pair], weights=weigh)[slot]
                    ruled_d = np.bincount(slot[pair], weights=(long_here[pair] > 0).astype(float))[slot]
            left_n, left_d = n - ruled_n, d - ruled_d
            space = left_n + left_d
            hit = open_ & (here > 0)
            log[hit] += np.log10(here[hit] / space[hit])
            miss = open_ & (here <= 0) & (left_d > 0)
            log[miss] += np.log10(left_d[miss] / space[miss])
            open_ = open_ & (here <= 0)
            longer = (context & mask, here)
        return pa.table({"code": pa.array(code), "value": pa.array(log)})

    return run


def held_out(id_col: str):
    """Whether a document is kept from training; a null id is not."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(PARTS)) == HELD_OUT, F.lit(False))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sent: int = SENT_ENTRIES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    A null text counts as empty: one token, the end. Scores are log10 probabilities. Repeated
    rows count in training as often as they occur. With no training document at all every count
    is 0 and bytes are spread evenly. An empty table gives an empty result.

    Tables of up to `sent` entries go to all tasks; beyond, each block of texts asks for its own terms once.
    """
    spark = docs.sparkSession
    docs = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        whole_text(text_col).alias("text"),
        held_out(id_col).alias("held_out"),
    )
    counts = docs.select("text", "held_out").mapInArrow(_counted, "kind int, code long, count long")
    counts = written(counts.groupBy("kind", "code").agg(F.sum("count").alias("count")), "counts")
    facts = counts.where(f"kind = {WORDS}").agg(F.sum("count"), F.count("*"), F.count_if(F.col("count") == 1)).first()
    ends = docs.agg(F.count_if(~F.col("held_out"))).first()[0]
    tokens, vocabulary = (facts[0] or 0) + ends, facts[1] + (ends > 0)
    spread = float(np.log10(tokens + vocabulary + 1))
    known = counts.where(f"kind = {WORDS}").select("code", F.log10(F.col("count") + 1.0).alias("value"))
    run_counts = counts.where(f"kind = {RUNS}").select("code", "count")
    pairs = np.zeros((256, END + 1), np.int64)  # a fixed number of cells
    pair = F.col("code").bitwiseAND(2 ** (SYMBOL_BITS + 8) - 1)
    for code, count in run_counts.groupBy(pair.alias("pair")).agg(F.sum("count")).collect():
        pairs[code >> SYMBOL_BITS, code & (2**SYMBOL_BITS - 1)] = count
    tail = F.shiftright("code", SYMBOL_BITS).bitwiseAND(0xFFFF)
    logs = written(
        run_counts.groupBy(tail.alias("tail")).applyInArrow(log_probabilities(pairs), "code long, value double"),
        "log-probabilities",
    )
    end = (ends, float(np.log10(ends + 1)))
    if vocabulary + logs.count() <= sent:
        scored = _by_sending(docs, known, logs)
    else:
        scored = _by_asking(docs, known, logs)
    return scored.select(
        "doc_id",
        "held_out",
        (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("n_known") + int(end[0] > 0)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("known_sum") + end[1] - (F.col("n_words") + 1) * spread).alias("base_score"),
        "score",
    )


SCORED = "doc_id long, held_out boolean, n_words long, n_known long, known_sum double, score double"


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    owner = np.repeat(np.arange(len(counts)), counts)
    return np.bincount(owner, weights=values, minlength=len(counts))


def _in_order(codes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes)
    return codes[order], values[order]


def _looked_up(table: tuple[np.ndarray, np.ndarray], codes: np.ndarray, default: float) -> np.ndarray:
    """Values of codes by binary search, each distinct code looked up once."""
    known, values = table
    if not len(known):
        return np.full(len(codes), default)
    distinct, which = np.unique(codes, return_inverse=True)
    at = np.minimum(np.searchsorted(known, distinct), len(known) - 1)
    return np.where(known[at] == distinct, values[at], default)[which]


def _scored(batch: pa.RecordBatch, words: tuple, runs: tuple) -> Iterator[pa.RecordBatch]:
    """Rows of SCORED for doc_id, text and held_out, by tables that hold what is known of their terms."""
    raw, edges = text_bytes(batch.column(1))
    for first, last in slices(edges, SLICE_BYTES):
        part = edges[first : last + 1]
        body, cuts = raw[part[0] : part[-1]], part - part[0]
        codes, n_words = _word_codes(body, cuts)
        values = _looked_up(words, codes, 0.0)
        run_codes, n_runs = _runs(body, cuts)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).slice(first, last - first),
                batch.column(2).slice(first, last - first),
                pa.array(n_words, pa.int64()),
                pa.array(_sums(values > 0, n_words).astype(np.int64)),
                pa.array(_sums(values, n_words)),
                pa.array(_sums(_looked_up(runs, run_codes, float("nan")), n_runs)),
            ],
            names=["doc_id", "held_out", "n_words", "n_known", "known_sum", "score"],
        )


def _by_sending(docs: DataFrame, known: DataFrame, logs: DataFrame) -> DataFrame:
    # Sorted arrays are searched as they were sent, so a worker holds them once and nothing beside them.
    tables = docs.sparkSession.sparkContext.broadcast(
        [_in_order(*(column.to_numpy() for column in table.toArrow().columns)) for table in (known, logs)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _scored(batch, *tables.value)

    return docs.mapInArrow(run, SCORED)


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, batch.schema, options=options) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(packed: Iterable[pa.Scalar]) -> Iterator[pa.RecordBatch]:
    for one in packed:
        yield from pa.ipc.open_stream(one.as_buffer())


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a task, packed, in blocks of about BLOCK_BYTES of text; a longer text is a block by itself."""
    block = size = 0
    for batch in batches:
        _, edges = text_bytes(batch.column(1))
        for first, last in slices(edges, SLICE_BYTES):
            more = int(edges[last] - edges[first]) + ROW_BYTES * (last - first)
            if size and size + more > BLOCK_BYTES:
                block, size = block + 1, 0
            size += more
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([_packed(batch.slice(first, last - first))], pa.binary())],
                names=["block", "texts"],
            )


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words and runs of each block; some come again where a block's are very many or its rows lie apart."""
    finds = {WORDS: _word_codes, RUNS: _runs}
    found: dict[int, list[np.ndarray]] = {kind: [] for kind in finds}
    asking = None

    def flush() -> Iterator[pa.RecordBatch]:
        for kind, parts in found.items():
            codes = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
            parts.clear()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(codes), asking, np.int64)),
                    pa.array(np.full(len(codes), kind, np.int32)),
                    pa.array(codes),
                ],
                names=["block", "kind", "code"],
            )

    for batch in batches:
        for block, texts in zip(batch.column(0).to_pylist(), batch.column(1)):
            if asking is not None and (block != asking or sum(len(c) for p in found.values() for c in p) > FLUSH):
                yield from flush()
            asking = block
            for part in _unpacked([texts]):
                raw, edges = text_bytes(part.column(1))
                for kind, find in finds.items():
                    found[kind].append(np.unique(find(raw, edges)[0]))
    if asking is not None:
        yield from flush()


def _answered(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """Rows of SCORED for one block."""
    kinds, codes, values = (answers[name].to_numpy() for name in ("kind", "code", "value"))
    words, runs = (_in_order(codes[kinds == kind], values[kinds == kind]) for kind in (WORDS, RUNS))
    return pa.Table.from_batches(
        [rows for batch in _unpacked(blocks["texts"]) for rows in _scored(batch, words, runs)]
    )


def _by_asking(docs: DataFrame, known: DataFrame, logs: DataFrame) -> DataFrame:
    # What moves for terms is a row for each distinct term of a block, not of a text. Texts move packed.
    blocks = docs.mapInArrow(_blocks, "block long, texts binary").select(
        (F.shiftleft(F.spark_partition_id().cast("long"), 32) + F.col("block")).alias("block"), "texts"
    )
    blocks = written(blocks, "score-blocks")
    table = known.withColumn("kind", F.lit(WORDS)).unionByName(logs.withColumn("kind", F.lit(RUNS)))
    asked = blocks.mapInArrow(_asked, "block long, kind int, code long")
    answers = asked.join(table, ["kind", "code"]).select("block", "kind", "code", "value")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_answered, SCORED)
