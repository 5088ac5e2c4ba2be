"""Join documents whose sets of five-word shingles are similar, and class them by links.

A grouped prefix join. Equal sets are one set. Shingles have a global order, rare ones first,
and two similar sets share one among their first ones (the prefix). Sets with the same prefix
and size form one group, which stands in the index once. A set is named by a 64-bit hash of its
shingles together with its size.

Candidates are found in turns, which gather sets into families. First, each list of the index
pairs neighbours in size order, in as many pairs as the lists have entries; pairs that share half
of their shingles are of one family, as two sets similar to a third one are. While many entries of
the lists are still apart, neighbours in random orders follow, again in no more pairs than entries.
Last, only what is still apart meets: within a list that holds several families, members outside
the largest one meet all others, and similar pairs join their families. A pair left out has both
ends in one family already, so no link is lost and families do not meet in all pairs. Sets of given
sizes must share a number of prefix shingles, so a set with many rare ones need look only into the
few shortest of its lists, or none. Every pair is verified on the whole sets.

Both ends of a link are in one family then, so all pairs of sets of a family are compared, and no
others. A family is dealt into blocks of sets; a task has two blocks and gets the shingles that all
their pairs share from one matrix product. It returns each set's links and the least set that they
lead to within the task, so that rows grow with a family's sets times its blocks, not with its
pairs. Classes are the components of these.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.components import components
from quayside.llm.numbers import Lookup, mix
from quayside.llm.tables import Working, small_batches, whole_text
from quayside.llm.word_hashes import shingle_hashes, slices, text_bytes, word_hashes

PERCENT = 75
# Of a family: sets that are similar to a third one share half of their shingles at least.
FAMILY_PERCENT = 50
# Prefixes are longer by n // SPARE than one common shingle needs: similar sets then share more
# than n // SPARE of theirs, n being the smaller size, and pairs that share fewer are no candidates.
SPARE = 32
# The most frequent shingles that are put last. Any order gives the same links; this one keeps
# lists short, and the number bounds what each task is sent (16 bytes each).
ORDERED = 1 << 17
LEAST_COUNT = 4
TEXT_BYTES = 1 << 18  # of texts whose words are hashed together, which bounds the memory of a worker
COUNTED = 1 << 22  # shingles counted together within a task
LIST_PART = 4096  # entries of a known long list that are put in order together
SKETCH_BITS = 1 << 25  # of the filter that keeps sets nobody asks for from being sent
BITMAP = 32_768  # bits in one of Spark's bitmaps
# Families in which only some pairs are similar are put together before all that is apart meets.
MORE_TURNS = 1  # at most so many more turns of neighbours; a second one found hardly any links
CROWD = 32  # ... while an entry of a mixed list would meet more than so many on average
SMALL_LIST = 16  # lists with no more entries outside the main class are left to the last turn
ORDERS = 4  # random orders of a turn
# In the last turn a set looks into as many of its shortest lists as similar sets must share one
# of, and so many more; they must then share so many more, too.
MORE_LISTS = 2
BLOCK = 512  # sets of a family, on average, that are compared with another such block in one task
COLUMNS = 1 << 13  # shingles in one matrix product of two blocks


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[np.ndarray]]]:
    """Batches of documents with the names of their sets and the sets, sorted."""
    for batch in batches:
        raw, edges = text_bytes(batch.column(1))
        for first, last in slices(edges, TEXT_BYTES):
            part = edges[first : last + 1]
            words, counts = word_hashes(raw[part[0] : part[-1]], part - part[0])
            hashes, n = shingle_hashes(words, counts)
            stops = np.cumsum(n)
            sets = [np.unique(hashes[b - k : b]) for b, k in zip(stops.tolist(), n.tolist(), strict=True)]
            sizes = np.array([len(s) for s in sets], np.uint64)
            sums = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
            yield batch.slice(first, last - first), mix(sums + sizes).view(np.int64), sets


def _once(seen: set, names: np.ndarray, sets: list[np.ndarray]) -> list[int]:
    """Places of non-empty sets that this task meets for the first time."""
    out = []
    for i, key in enumerate(zip(names.tolist(), map(len, sets), strict=True)):
        if key[1] and key not in seen:
            seen.add(key)
            out.append(i)
    return out


def _repeated(waiting: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that occur repeatedly in the sets, and how often; takes the sets out of the list.

    They are sorted in one copy, as workers stay and keep what they once held.
    """
    tokens = np.concatenate(waiting)
    waiting.clear()
    tokens.sort()
    same = np.concatenate([[False], tokens[1:] == tokens[:-1], [False]])
    ends = np.flatnonzero(same[1:] != same[:-1])  # first and last places of runs
    firsts, lasts = ends[::2], ends[1::2]
    return tokens[firsts], lasts - firsts + 1


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, set_id and n of documents; beside them shingles that a task met repeatedly."""
    seen: set = set()
    waiting: list[np.ndarray] = []

    def counted() -> pa.RecordBatch:
        tokens, counts = _repeated(waiting)
        blob = lambda x, kind: pa.array([x.astype(kind).tobytes()], pa.binary())
        nothing = pa.array([None], pa.int64())
        return pa.RecordBatch.from_arrays(
            [nothing, nothing, pa.array([-1], pa.int32()), blob(tokens, np.uint64), blob(counts, np.int64)],
            names=["doc_id", "set_id", "n", "tokens", "counts"],
        )

    for batch, names, sets in _sets(batches):
        waiting += [sets[i] for i in _once(seen, names, sets)]
        blank = pa.nulls(len(names), pa.binary())
        sizes = pa.array([len(s) for s in sets], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(names), sizes, blank, blank],
            names=["doc_id", "set_id", "n", "tokens", "counts"],
        )
        if sum(map(len, waiting)) > COUNTED:
            yield counted()
    if waiting:
        yield counted()


def _unpacked_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for tokens, counts in zip(batch.column(0), batch.column(1), strict=True):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.frombuffer(tokens.as_py(), np.int64)),
                    pa.array(np.frombuffer(counts.as_py(), np.int64)),
                ],
                names=["token", "count"],
            )


def _prefixes(tokens: np.ndarray, counts: np.ndarray):
    """For each set once per task: its group, and the group's prefix and salts once per task."""
    order = np.lexsort((tokens, counts))
    last = Lookup(tokens[order], np.arange(1, len(order) + 1, dtype=np.int32), np.int32(0))
    parts = np.maximum(1, -(-counts[order] // LIST_PART)).astype(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        groups: set = set()
        for _, names, sets in _sets(batches):
            places = _once(seen, names, sets)
            if not places:
                continue
            ranks = last.get(np.concatenate([sets[i] for i in places]).view(np.int64))
            out, at = [], 0
            for i in places:
                hashes, n = sets[i], len(sets[i])
                rank = ranks[at : at + n]
                at += n
                length = _prefix_length(n)
                first = np.argsort(rank, kind="stable")[:length] if rank.any() else slice(0, length)
                prefix, rank = hashes[first], rank[first]
                group = int(mix(mix(prefix).sum(dtype=np.uint64)[None] + np.uint64(n)).view(np.int64)[0])
                if (group, n) in groups:
                    out.append((int(names[i]), n, group, None, None))
                    continue
                groups.add((group, n))
                split = np.where(rank > 0, parts[rank - 1], 1) if len(parts) else np.ones(len(rank), np.uint64)
                part = (mix(prefix ^ np.uint64(group & (2**64 - 1))) % split.astype(np.uint64)).astype(np.int32)
                salt = np.where(split > 1, part + 1, 0).astype(np.int32)  # 0: the list is whole
                out.append((int(names[i]), n, group, prefix.view(np.int64), salt))
            columns = list(zip(*out, strict=True))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                names=["set_id", "n", "group_id", "tokens", "salts"],
            )

    return run


def _wanted_sets(bitmaps: dict[int, bytes]):
    """set_id, n and the shingles of sets that the sketch holds, once per task."""
    sketch = np.zeros(SKETCH_BITS, np.uint8)
    for bucket, bits in bitmaps.items():
        flags = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
        sketch[(bucket - 1) * BITMAP : bucket * BITMAP] = flags
    packed = np.packbits(sketch).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.frombuffer(packed, np.uint8)
        seen: set = set()
        for _, names, sets in _sets(batches):
            at = names & (SKETCH_BITS - 1)
            asked = flags[at >> 3] >> (7 - (at & 7)) & 1
            places = [i for i in _once(seen, names, sets) if asked[i]]
            for start in range(0, len(places), 256):
                some = places[start : start + 256]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names[some]),
                        pa.array([len(sets[i]) for i in some], pa.int32()),
                        pa.array([sets[i].view(np.int64) for i in some], pa.list_(pa.int64())),
                    ],
                    names=["set_id", "n", "shingles"],
                )

    return run


def similar(common, left, right, percent=PERCENT):
    return 100 * common >= percent * (left + right - common)


def _shingles_of(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """set_id, n and shingles of the sets whose names are asked for in column id, and of a few more."""
    place = F.col("id").bitwiseAND(SKETCH_BITS - 1)
    bitmaps = dict(
        asked.groupBy(F.bitmap_bucket_number(place + 1).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place + 1)))
        .collect()
    )  # at most SKETCH_BITS / BITMAP rows
    wanted = docs.mapInArrow(_wanted_sets(bitmaps), "set_id long, n int, shingles array<bigint>")
    return wanted.dropDuplicates(["set_id", "n"])


def _verified(docs: DataFrame, pairs: DataFrame, work: Working, percent: int = PERCENT) -> DataFrame:
    """Of pairs of sets (a, a_n, b, b_n) those that share so many percent of their shingles."""
    pairs = work.written(pairs, "pairs")
    asked = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    wanted = _shingles_of(docs, asked)
    side = lambda x: wanted.select(
        F.col("set_id").alias(x), F.col("n").alias(f"{x}_n"), F.col("shingles").alias(f"{x}_set")
    )
    both = pairs.join(side("a"), ["a", "a_n"]).join(side("b"), ["b", "b_n"])
    common = F.size(F.array_intersect("a_set", "b_set"))
    alike = similar(common, F.col("a_n"), F.col("b_n"), percent)
    links = work.written(both.where(alike).select("a", "a_n", "b", "b_n"), "links")
    work.drop(pairs)
    return links


def _in_common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each of the left sets shares with each of the right ones."""
    sides = [(np.concatenate(x), np.repeat(np.arange(len(x)), [len(s) for s in x])) for x in (left, right)]
    shared = np.intersect1d(sides[0][0], sides[1][0])
    common = np.zeros((len(left), len(right)), np.int64)
    for start in range(0, len(shared), COLUMNS):
        part = shared[start : start + COLUMNS]
        tables = []
        for (tokens, rows), n in zip(sides, common.shape, strict=True):
            at = np.minimum(np.searchsorted(part, tokens), len(part) - 1)
            hit = part[at] == tokens
            table = np.zeros((n, len(part)), np.float32)  # sums below 2 ** 24 are exact
            table[rows[hit], at[hit]] = 1
            tables.append(table)
        common += (tables[0] @ tables[1].T).astype(np.int64)
    return common


def _least_linked(linked: np.ndarray) -> np.ndarray:
    """Of the nodes of a symmetric table of links, the least node reachable from each."""
    least = np.arange(len(linked))
    ends = np.nonzero(linked)
    while len(ends[0]):
        seen = least.copy()
        np.minimum.at(seen, ends[0], least[ends[1]])
        seen = seen[seen]
        if (seen == least).all():
            break
        least = seen
    return least


def _compared(table: pa.Table) -> pa.Table:
    """set_id, n, links and a linked set of sets within each task (two blocks, or one with itself) of a bucket."""
    names, sizes, tasks, kinds = (table.column(c).to_numpy() for c in ("set_id", "n", "task", "kind"))
    shingles = table.column("shingles").combine_chunks()
    edges, values = shingles.offsets.to_numpy(), shingles.values.to_numpy()
    order = np.lexsort((kinds, tasks))
    starts = np.flatnonzero(np.diff(tasks[order], prepend=tasks[order[0]] - 1))
    links = np.zeros(len(names), np.int64)
    to = np.arange(len(names))
    for places in np.split(order, starts[1:]):
        one, two = (places[kinds[places] == k] for k in (1, 2))
        itself = kinds[places[0]] == 0
        one, two = (places, places) if itself else (one, two)
        if not len(one) or not len(two):
            continue
        left = [values[edges[i] : edges[i + 1]] for i in one]
        common = _in_common(left, left if itself else [values[edges[i] : edges[i + 1]] for i in two])
        linked = similar(common, sizes[one][:, None].astype(np.int64), sizes[two][None, :].astype(np.int64))
        if itself:
            np.fill_diagonal(linked, False)
            to[places] = places[_least_linked(linked)]
        else:
            links[two] += linked.sum(axis=0)
            across = np.zeros((len(places), len(places)), bool)  # places has one before two
            across[: len(one), len(one) :] = linked
            to[places] = places[_least_linked(across | across.T)]
        links[one] += linked.sum(axis=1)
    return pa.table({"set_id": names, "n": sizes, "links": links, "to": names[to], "to_n": sizes[to]})


def compared(docs: DataFrame, families: DataFrame, work: Working) -> DataFrame:
    """Links of all sets in `families`, from all pairs of sets of a family.

    `families` holds set_id, n and class, the family, of each set that is in one with others. A row
    is of a set and a block of its family: set_id, n, links, the number of similar sets that it
    was compared with there, and to and to_n, a set (or itself) that links lead to. A family's
    links connect the same sets as its rows do. The rows are a table of `work`.
    """
    counts = families.groupBy("class").agg(F.count("*").alias("sets")).withColumn("blocks", F.ceil(F.col("sets") / BLOCK))
    small = families.count() // BLOCK + 1  # families of one block share buckets
    own, other = F.col("own"), F.col("other")
    dealt = (
        families.join(counts, "class")
        .withColumn("own", F.pmod(F.xxhash64("set_id", "n"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("task", F.xxhash64("class", F.least(own, other), F.greatest(own, other)))
        .select(
            "set_id",
            "n",
            "task",
            F.when(F.col("blocks") > 1, F.col("task")).otherwise(F.pmod("task", F.lit(small))).alias("bucket"),
            F.when(own == other, 0).when(own < other, 1).otherwise(2).alias("kind"),
        )
    )
    sets = _shingles_of(docs, families.select(F.col("set_id").alias("id")))
    rows = dealt.join(sets, ["set_id", "n"]).groupBy("bucket")
    return work.written(rows.applyInArrow(_compared, "set_id long, n int, links long, to long, to_n int"), "compared")


def _node(name: str, size: str):
    return F.struct(F.col(size).alias("n"), F.col(name).alias("id"))


def _classes(links: DataFrame, work: Working, label: str) -> DataFrame:
    """set_id, n and class, the class's smallest set, of every set in a link, as a table of `work`."""
    rounds = Working()
    found = components(links.select(_node("a", "a_n").alias("a"), _node("b", "b_n").alias("b")), rounds)
    named = found.select(F.col("node.id").alias("set_id"), F.col("node.n").alias("n"), F.col("root").alias("class"))
    table = work.written(named, label)
    rounds.drop_others()
    return table


def _prefix_length(n):
    """Of sets of n shingles."""
    return n - (PERCENT * n + 99) // 100 + 1 + n // SPARE


def _least_shared(left, right):
    """How many prefix shingles two similar sets of these sizes have in common at least.

    Similar sets share at least PERCENT * (left + right) / (100 + PERCENT) shingles. Of the set
    whose prefix ends first in the global order, prefix shingles that the other set has are in
    the other's prefix, so those not shared there are lost; only the rest can make up for them.
    """
    spared = lambda n: F.lit(1) + F.floor(n / SPARE) - F.ceil(PERCENT * n / 100)
    common = F.ceil(PERCENT * (left + right) / (100 + PERCENT))
    return F.least(spared(left), spared(right)) + common


def _in_reach(small: str, large: str):
    return 100 * F.col(small) >= PERCENT * F.col(large)


def classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    count_links: bool = True,
    work: Working | None = None,
) -> DataFrame:
    """doc_id, n_shingles, component_id, class_texts, links and set_id of every row.

    Class_texts is the number of distinct sets in the class, links the number of other distinct
    sets that are similar to the row's own; rows of equal sets share a set_id and are one end.
    Without `count_links` there is no such column.

    Words are lower-cased in A-Z. A null or wordless text has no shingles and is linked with
    nothing: its component is its own id. Equal texts are linked. Repeated rows stay. A null
    id is kept, and a component takes its smallest id that is not null. An empty table gives
    an empty result.

    Working tables are dropped as the steps that read them end; what the result reads stays in
    `work`, for a caller that knows when the result has been read.
    """
    with small_batches(docs.sparkSession):
        return _classes_of(docs, id_col, text_col, count_links, work or Working())


def _classes_of(docs: DataFrame, id_col: str, text_col: str, count_links: bool, work: Working) -> DataFrame:
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    first = work.written(
        docs.mapInArrow(_named, "doc_id long, set_id long, n int, tokens binary, counts binary"), "set-names"
    )
    named = work.written(first.where("n >= 0").select("doc_id", "set_id", "n"), "sets")
    frequent = (
        first.where("n < 0")
        .select("tokens", "counts")
        .mapInArrow(_unpacked_counts, "token long, count long")
        .groupBy("token")
        .agg(F.sum("count").alias("count"))
        .where(F.col("count") >= LEAST_COUNT)
        .orderBy(F.col("count").desc(), "token")
        .limit(ORDERED)
        .toArrow()
    )
    work.drop(first)
    order = (frequent["token"].to_numpy(), frequent["count"].to_numpy())
    entries = work.written(
        docs.mapInArrow(
            _prefixes(*order), "set_id long, n int, group_id long, tokens array<bigint>, salts array<int>"
        ),
        "prefixes",
    )
    members = work.written(entries.select("group_id", "n", "set_id").distinct(), "members")
    # The index. Tasks may have sent a group each; lists of one group go, parts of long lists stay.
    index = entries.where("tokens is not null").select(
        F.explode(F.arrays_zip("tokens", "salts")).alias("x"), "group_id", "n"
    )
    list_part = Window.partitionBy("token", "salt")
    before = F.lag(F.struct("n", "group_id")).over(list_part.orderBy("n", "group_id"))
    index = work.written(
        index.select(F.col("x.tokens").alias("token"), F.col("x.salts").alias("salt"), "group_id", "n")
        .withColumn("before", before)
        .where("before is null or before.n <> n or before.group_id <> group_id")
        .withColumn("entries", F.count("*").over(list_part))
        .where("entries > 1 or salt > 0"),
        "index",
    )
    work.drop(entries)
    heads = members.groupBy("group_id", "n").agg(F.min("set_id").alias("set_id"))
    neighbours = index.select(
        F.col("before.group_id").alias("a_group"), F.col("before.n").alias("a_n"),
        F.col("group_id").alias("b_group"), F.col("n").alias("b_n"),
    ).where(F.col("a_group").isNotNull() & _in_reach("a_n", "b_n"))
    # The first turn may leave pairs out, as the second sees all that are still apart.
    often = 2 + F.floor(F.least("a_n", "b_n") / (4 * SPARE))
    neighbours = (
        neighbours.groupBy(*neighbours.columns).agg(F.count("*").alias("times"))
        .where((F.col("times") >= often) | (F.least("a_n", "b_n") < SPARE))
    )
    head = lambda x: heads.select(
        F.col("group_id").alias(f"{x}_group"), F.col("n").alias(f"{x}_n"), F.col("set_id").alias(x)
    )
    across = neighbours.join(head("a"), ["a_group", "a_n"]).join(head("b"), ["b_group", "b_n"])
    in_group = Window.partitionBy("group_id", "n").orderBy("set_id")
    within = members.withColumn("before", F.lag("set_id").over(in_group)).where("before is not null")
    sides = ["a", "a_n", "b", "b_n"]
    turn_one = _verified(
        docs,
        across.select(*sides).unionByName(
            within.select(F.col("before").alias("a"), F.col("n").alias("a_n"), F.col("set_id").alias("b"), F.col("n").alias("b_n"))
        ),
        work,
        FAMILY_PERCENT,
    )
    links, together = [turn_one], _classes(turn_one, work, "families")
    crowds = members.groupBy("group_id", "n").agg(F.count("*").alias("members")).where("members > 1")
    # Lists in parts are of the ORDERED shingles, so a broadcast of them is bounded.
    long = index.where("salt > 0").groupBy("token").agg(F.count("*").alias("whole"))
    of_group = Window.partitionBy("group_id", "n")
    least = 1 + F.floor(F.ceil(PERCENT * F.col("n") / 100) / SPARE)  # lists that any two similar sets share
    lists = (
        index.select("token", "group_id", "n", "entries")
        .join(F.broadcast(long), "token", "left")
        .withColumn("entries", F.coalesce("whole", "entries"))
        .withColumns(
            {
                "place": F.row_number().over(of_group.orderBy("entries", "token")),
                "held": F.count("*").over(of_group).cast("int"),
            }
        )
        .where(F.col("held") >= least)
    )
    placed = work.written(_with_class(members, together), "members")
    work.drop(together)
    units = (
        lists.join(placed, ["group_id", "n"])
        .select("token", "set_id", "n", "place", "held", F.lit(False).alias("grouped"), "class")
        .unionByName(
            placed.join(crowds, ["group_id", "n"]).select(
                F.col("group_id").alias("token"), "set_id", "n", F.lit(0).alias("place"), F.lit(0).alias("held"), F.lit(True).alias("grouped"), "class"
            )
        )
    )
    mixed = _mixed(units, work)
    work.drop(members, index, placed)
    for turn in range(MORE_TURNS):
        if not _crowded(mixed):
            break
        links.append(_verified(docs, _neighbours(mixed, turn), work, FAMILY_PERCENT))
        together = _classes(reduce(DataFrame.unionByName, links), work, "families")
        before, mixed = mixed, _mixed(
            _with_class(mixed.select(*(c for c in units.columns if c != "class")), together), work
        )
        work.drop(before, together)
    links.append(_verified(docs, _apart(mixed).select(*sides), work))
    work.drop(mixed)
    families = _classes(reduce(DataFrame.unionByName, links), work, "families")
    work.drop(*links)
    found = compared(docs, families, work)
    work.drop(families)
    one, other = F.struct("n", "set_id"), F.struct(F.col("to_n").alias("n"), F.col("to").alias("set_id"))
    linked = found.where(one != other).select(
        F.col("set_id").alias("a"), F.col("n").alias("a_n"), F.col("to").alias("b"), F.col("to_n").alias("b_n")
    )
    ends = _classes(linked, work, "classes")
    # Ids: of a set, of a class, and back to the rows.
    least_ids = work.written(named.groupBy("set_id", "n").agg(F.min("doc_id").alias("least")), "least-ids")
    in_class = F.coalesce("class", F.struct(F.col("n").alias("n"), F.col("set_id").alias("id")))
    least = work.written(
        least_ids.join(ends, ["set_id", "n"], "left").withColumn("class", in_class), "set-classes"
    )
    work.drop(least_ids, ends)
    per_class = least.where("n > 0").groupBy("class").agg(F.min("least").alias("component_id"), F.count("*").alias("sets"))
    ids = work.written(
        least.where("n > 0").join(per_class, "class").select("set_id", "n", "component_id", "sets"), "component-ids"
    )
    work.drop(least)
    counted = []
    if not count_links:
        work.drop(found)
    else:
        ids = ids.join(found.groupBy("set_id", "n").agg(F.sum("links").alias("links")), ["set_id", "n"], "left")
        counted = [F.coalesce("links", F.lit(0)).alias("links")]
    return named.join(ids, ["set_id", "n"], "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("sets", F.lit(1)).alias("class_texts"),
        *counted,
        "set_id",
    )


def _with_class(sets: DataFrame, together: DataFrame) -> DataFrame:
    """Sets with their class, which is their own where they are in none with others."""
    alone = F.struct(F.col("n").alias("n"), F.col("set_id").alias("id"))
    return sets.join(together, ["set_id", "n"], "left").withColumn("class", F.coalesce("class", alone))


def _mixed(units: DataFrame, work: Working) -> DataFrame:
    """Entries of lists that hold several classes: class, is_main, and the list's size and others.

    A list's main class is its largest one; others are the entries outside it.
    """
    units = work.written(units, "units")
    largest = F.max(F.struct("entries", "class"))
    main = (
        units.groupBy("token", "class")
        .agg(F.count("*").alias("entries"))
        .groupBy("token")
        .agg(largest["class"].alias("main"), F.sum("entries").alias("size"), (F.sum("entries") - F.max("entries")).alias("others"))
        .where("others > 0")
    )
    main = work.written(main, "main-classes")
    flagged = units.join(main, "token").withColumn("is_main", F.col("class") == F.col("main")).drop("main")
    mixed = work.written(flagged, "mixed-units")
    work.drop(units, main)
    return mixed


def _crowded(mixed: DataFrame) -> bool:
    """Whether entries would meet more than CROWD others on average if all that are apart met."""
    meetings = F.sum(F.when(~F.col("is_main"), F.col("size")).otherwise(0))
    found = mixed.agg(meetings.alias("meetings"), F.count("*").alias("entries")).first()
    return found["entries"] > 0 and found["meetings"] > CROWD * found["entries"]


def _neighbours(mixed: DataFrame, turn: int) -> DataFrame:
    """Pairs of neighbours of different classes, in long mixed lists put in one of a few random orders.

    Lists share their orders, so that most neighbours are the same ones in many lists.
    """
    part = F.pmod(F.xxhash64("set_id", F.lit(turn)), F.ceil(F.col("size") / LIST_PART))
    order = F.xxhash64("set_id", F.pmod("token", F.lit(ORDERS)), F.lit(turn))
    in_list = Window.partitionBy("token", "part").orderBy("order", "set_id", "n")
    ends = F.struct("n", "set_id", "class")
    pairs = (
        mixed.where(F.col("others") > SMALL_LIST)
        .withColumns({"part": part, "order": order})
        .select("set_id", "n", "class", F.lag(ends).over(in_list).alias("before"))
        .where("before is not null and before.class <> class")
        .select(F.least(ends, "before").alias("a"), F.greatest(ends, "before").alias("b"))
        .select(
            F.col("a.set_id").alias("a"), F.col("a.n").alias("a_n"), F.col("b.set_id").alias("b"), F.col("b.n").alias("b_n")
        )
    )
    return pairs.where(_in_reach("a_n", "b_n") & _in_reach("b_n", "a_n")).distinct()


def _apart(units: DataFrame) -> DataFrame:
    """Pairs of one list, or of one group, that are not yet in one class."""
    side = lambda x, *more: units.select(
        "token", F.struct("n", F.col("set_id").alias("id"), "class", "held", "place").alias(x), *more
    )
    one = side("a", "is_main", "grouped").where("not is_main").drop("is_main")
    a, b = F.col("a"), F.col("b")
    name = lambda x: F.struct(x["n"], x["id"])
    need = _least_shared(a["n"], b["n"])
    # The side with fewer lists decides which of them count: its shortest ones.
    by_a = F.struct(a["held"], a["n"], a["id"]) < F.struct(b["held"], b["n"], b["id"])
    late = F.when(by_a, a["held"] - a["place"]).otherwise(b["held"] - b["place"])
    listed = (late >= need - MORE_LISTS - 1) & (F.least(a["held"], b["held"]) >= need)
    meet = one.join(side("b", "is_main"), "token").where(
        (a["class"] != b["class"])
        & (F.col("is_main") | (name(a) < name(b)))
        & (100 * a["n"] >= PERCENT * b["n"])
        & (100 * b["n"] >= PERCENT * a["n"])
        & (F.col("grouped") | listed)
    )
    # The same pair may have met either way round.
    pair = (F.least(name(a), name(b)), F.greatest(name(a), name(b)))
    shared = (
        meet.select(pair[0].alias("a"), pair[1].alias("b"), "grouped")
        .groupBy("a", "b")
        .agg(F.count("*").alias("lists"), F.max("grouped").alias("grouped"))
    )
    # Members of one group have their whole prefix in common.
    enough = F.col("lists") >= F.least(F.lit(MORE_LISTS + 1), _least_shared(a["n"], b["n"]))
    return shared.where(enough | F.col("grouped")).select(
        a["id"].alias("a"), a["n"].alias("a_n"), b["id"].alias("b"), b["n"].alias("b_n")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """Of each class the document with the smallest id, with the columns of `docs`.

    Texts without words are nobody's copies and stay. Of rows that are tied one is kept; a
    class without any id keeps one of its rows.
    """
    names = docs.columns
    work = Working()
    rows = work.written(
        docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("kept_row"))
        .withColumn("row", F.monotonically_increasing_id()),
        "join-rows",
        texts=True,
    )
    asked = rows.select(F.col("row").alias("doc_id"), F.col("kept_row.text").alias("text"))
    found = classes(asked, count_links=False, work=work)  # rows stand in for ids, which may be null or repeated
    ids = rows.select("row", F.col("kept_row.doc_id").cast("long").alias("doc_id"))
    placed = found.select(F.col("doc_id").alias("row"), "component_id").join(ids, "row")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    keep = placed.groupBy("component_id").agg(F.min(first).alias("first")).select(F.col("first.row").alias("row"))
    keep = work.written(_bits(keep), "kept-rows")
    work.drop_others(rows, keep)
    return _with_bits(rows, keep).select("kept_row.*")


def _bits(rows: DataFrame) -> DataFrame:
    """bucket and bits: the numbers in column row, BITMAP to a bucket, one bit for each."""
    number = F.bitmap_bucket_number(F.col("row") + 1)
    return rows.groupBy(number.alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("row") + 1)).alias("bits")
    )


def _with_bits(rows: DataFrame, bits: DataFrame) -> DataFrame:
    """The rows whose numbers have a bit.

    Bits are a small part of the rows, so Spark may send them to all tasks instead of moving whole
    texts to find which of them stay.
    """
    place = F.bitmap_bit_position(F.col("row") + 1)
    byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.getbit(byte, (place % 8).cast("int")) == 1
    return rows.join(bits, F.bitmap_bucket_number(F.col("row") + 1) == F.col("bucket")).where(held)
