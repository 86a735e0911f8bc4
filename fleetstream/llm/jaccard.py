"""Near-duplicate texts by a parity-sketch join on word shingles.

A text's set of shingles is hashed into the blocks of a sketch; a block is the XOR of the
hashes that fall into it, so the sketches of two sets differ in no more blocks than the
sets have elements that only one of them has. Sets with a Jaccard similarity of at least
3/4 differ in D <= (|A| + |B|) / 7 elements. Sketches are made per band of set sizes, with
more blocks than D, so at least blocks - D of them agree (pigeonhole); hence, in any order
common to all sets, two such sets agree on at least e of their first D + e blocks each, and
only those are joined. The order has blocks of frequent shingles last: a passage that many
texts share brings nobody together who is not alike otherwise.

Sets that agree on a block are grouped. A link is tested with the sketch of bits, whose
Hamming distance is a lower bound for the difference, and then with the whole texts. First
every set is tested with the least ids of its groups. In groups that this has not joined to
one component, every member outside the largest one is tested with every member of another
component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from fleetstream.llm.components import components
from fleetstream.llm.storage import (
    broadcast_if_small,
    in_tasks_of,
    release_memory,
    releasing,
    ship_package,
    shuffle_partitions,
    written,
)
from fleetstream.llm.windows import Sums, Texts, lower_ascii, mixed, words

SHINGLE_WORDS = 5
#: Bits of the sketch that is compared before texts are; those of large sets have more.
SKETCH_BITS = 1024
#: Bands end at these powers; a band's sketches have at least so many blocks.
_BAND = 8
_LEAST_BLOCKS = 4096
#: Texts of a cluster that are compared in one group, on either side.
_CELL = 256
#: Members of a key that are paired in one group, on either side.
_MEMBERS = 8192
#: Texts, members of open groups, pairs of whole texts and rows of a few numbers that one
#: task handles, where there are few.
_TASK_TEXTS = 2_500
_TASK_MEMBERS = 50_000
_TASK_ROWS = 100_000
_TASK_PAIRS = 2_000
#: Shingles in at least this share of the texts are put last, the most frequent of them.
FREQUENT_SHARE = 0.001
MOST_FREQUENT = 100_000
_LEAST_FREQUENT = 8


def shingle_sets(texts: Texts, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the different shingles of each text, in order.

    Words are lower-cased in A-Z; a text with fewer than ``size`` words has them all as
    one shingle, and one without words has none.
    """
    units = words(lower_ascii(texts))
    sums, n = Sums(units.hashes), len(units.hashes)
    at = np.arange(max(n - size + 1, 0))
    whole = units.text[at] == units.text[at + size - 1] if len(at) else np.zeros(0, bool)
    at = at[whole]
    counts = np.bincount(units.text, minlength=len(texts))
    short = np.flatnonzero((counts > 0) & (counts < size))
    begin = np.searchsorted(units.text, short)
    text = np.concatenate([units.text[at], short])
    shingle = np.concatenate([sums.of(at, at + size), sums.of(begin, begin + counts[short])])
    if len(short):
        order = np.argsort(text, kind="stable")
        text, shingle = text[order], shingle[order]
    ends = np.append(np.flatnonzero(text[1:] != text[:-1]) + 1, len(text))
    begin = 0
    for end in ends.tolist():
        shingle[begin:end].sort()
        begin = end
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])
    return text[new], shingle[new]


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, int]]:
    """doc_ids, text, shingle and number of texts, a few megabytes at a time."""
    ids = batch.column("doc_id").cast(pa.int64())
    for first, texts in Texts.of(batch.column("text")).slices():
        text, shingle = shingle_sets(texts)
        yield ids.slice(first, len(texts)), text, shingle, len(texts)


def _per_text(values: np.ndarray, text: np.ndarray, texts: int, how: np.ufunc) -> np.ndarray:
    out = np.zeros(texts, dtype=np.uint64)
    if len(text):
        at = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
        out[text[at]] = how.reduceat(values, at)
    return out


def _bit_sketches(text: np.ndarray, shingle: np.ndarray, texts: int) -> list[np.ndarray]:
    """Per text the parities of its shingles, in words of 64 bits.

    The widths are powers of two: SKETCH_BITS, and for large sets at least 3/4 of their size,
    since a sketch with much fewer bits than shingles is as far from any other.
    """
    size = np.bincount(text, minlength=texts)
    wide = np.ceil(np.log2(np.maximum(size * 0.75, 1))).astype(np.int64)
    bits = np.maximum(np.int64(1) << wide, SKETCH_BITS)
    begin = np.append(0, np.cumsum(bits))
    bit = mixed(shingle ^ np.uint64(0x5BD1)) & (bits[text] - 1).astype(np.uint64)
    odd = np.bincount(begin[text] + bit.astype(np.int64), minlength=begin[-1]) & 1
    return np.split(np.packbits(odd.astype(np.uint8)).view(np.uint64), begin[1:-1] // 64)


def _folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches, one per row, at a smaller width: bits with the same remainder fall together."""
    return np.bitwise_xor.reduce(sketches.reshape(len(sketches), -1, words), axis=1)


def shingle_summaries(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_a, set_b, sketch, fine: per row the set's size and hashes.

    ``sketch`` has SKETCH_BITS; ``fine`` is the sketch of a large set, else null.
    """
    coarse = SKETCH_BITS // 64

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            for ids, text, shingle, n in _slices(batch):
                sketches = _bit_sketches(text, shingle, n)
                sums = [
                    _per_text(mixed(shingle ^ np.uint64(salt)), text, n, np.add)
                    for salt in (0x1357, 0x2468)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.bincount(text, minlength=n)),
                        *[pa.array(s.view(np.int64)) for s in sums],
                        pa.array([_folded(x[None], coarse).tobytes() for x in sketches], pa.binary()),
                        pa.array(
                            [x.tobytes() if len(x) > coarse else None for x in sketches],
                            pa.binary(),
                        ),
                    ],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "sketch", "fine"],
                )
        release_memory()

    return docs.select("doc_id", "text").mapInArrow(
        summaries,
        "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, sketch binary, fine binary",
    )


def frequent_shingles(docs: DataFrame, number: int) -> np.ndarray:
    """Hashes of the shingles in the largest numbers of texts, at most MOST_FREQUENT.

    A shingle above the share in all texts is above it in some task's texts, so a task
    sends only those. Which shingles count as frequent changes the work, not the result.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        held, texts, size = [], 0, 0

        def frequent() -> pa.RecordBatch:
            shingle, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= max(2, FREQUENT_SHARE * texts)
            return pa.RecordBatch.from_arrays(
                [pa.array(shingle[often].view(np.int64)), pa.array(n[often])],
                names=["shingle", "n"],
            )

        for batch in batches:
            for _, _, shingle, n in _slices(batch):
                held.append(shingle)
                texts, size = texts + n, size + len(shingle)
                if size > 1_500_000:
                    yield frequent()
                    held, texts, size = [], 0, 0
        if held:
            yield frequent()
        release_memory()

    counted = docs.select("doc_id", "text").mapInArrow(count, "shingle bigint, n bigint")
    often = max(_LEAST_FREQUENT, FREQUENT_SHARE * number)
    top = (
        counted.groupBy("shingle")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= often)
        .orderBy(F.desc("n"), "shingle")
        .limit(MOST_FREQUENT)
    )
    return np.sort(np.array([r["shingle"] for r in top.collect()], dtype=np.int64)).view(
        np.uint64
    )


def _is_in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def _level(size: np.ndarray) -> np.ndarray:
    """The band of a set: sizes from _BAND**level."""
    edges = _BAND ** np.arange(1, 20, dtype=np.int64)
    return np.searchsorted(edges, size, "right")


def needed_agreements(size: np.ndarray) -> np.ndarray:
    """e: blocks beyond D that a set joins on, and so shares with sets not smaller."""
    return size // 12 + 1


def sketch_blocks(
    text: np.ndarray, shingle: np.ndarray, frequent: np.ndarray, texts: int
) -> tuple[np.ndarray, np.ndarray]:
    """(text, key) of the first D + e blocks of every set in its bands' sketches."""
    size = np.bincount(text, minlength=texts)
    extra = needed_agreements(size)
    often = _is_in(shingle, frequent)
    own = _level(size)
    found = []
    # A set also meets smaller sets of the band below if it is near the border.
    below = (own > 0) & (size * 3 <= (np.int64(_BAND) ** own - 1) * 4)
    for down in (0, 1):
        use = size > 0 if not down else below
        chosen = use[text]
        if not chosen.any():
            continue
        t, s, common = text[chosen], shingle[chosen], often[chosen]
        level = own - down
        top = np.int64(_BAND) ** (level + 1) - 1
        # The partner is at most 4/3 of the set, and of the band below when that is met.
        partner = size * 4 // 3 if not down else np.minimum(size, top)
        most = (size + partner) // 7 + extra - 1
        blocks = np.maximum(_LEAST_BLOCKS, 4 * (top // 3 + 1)).astype(np.uint64)
        # Shingles come in the order of their hashes, and so of their blocks.
        place = (s >> np.uint64(32)) * blocks[t] >> np.uint64(32)
        at = np.flatnonzero(np.append(True, (t[1:] != t[:-1]) | (place[1:] != place[:-1])))
        common = np.logical_and.reduceat(common, at)
        parity = np.bitwise_xor.reduceat(s, at)
        t, place = t[at], place[at]
        salt = level[t].astype(np.uint64) << np.uint64(40)
        key = mixed(mixed(parity) ^ mixed(place ^ salt))
        # Rank in the common order: first what is not frequent, then by block.
        first = np.searchsorted(t, np.arange(texts))
        rare = np.cumsum(~common)
        before = (rare - ~common)[np.minimum(first, len(t) - 1)]
        rares = np.bincount(t[~common], minlength=texts)
        order = np.arange(len(t)) - first[t]
        rank = np.where(common, rares[t] + order - (rare - before[t]), rare - before[t] - 1)
        keep = rank <= most[t]
        found.append((t[keep], key[keep]))
        for one in np.flatnonzero(use & (np.bincount(t, minlength=texts) <= most)):
            found.append(
                _empty_blocks(one, place[t == one], int(most[one]), int(blocks[one]), level[one])
            )
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(c) for c in zip(*found))


def _empty_blocks(one: int, full: np.ndarray, most: int, blocks: int, level: int):
    """A set with too few blocks that are not empty also joins on empty ones, the last in
    the common order."""
    empty = np.setdiff1d(np.arange(blocks, dtype=np.uint64), full)
    key = mixed(empty ^ np.uint64(int(level) << 40 | 1 << 62))[: most + 1 - len(full)]
    return np.full(len(key), one, dtype=np.int64), key


def block_groups(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """key, doc_id, size of the sets that agree on a block.

    Equal sets that are read together are sent once, by the least of their ids.
    """
    spark = docs.sparkSession
    parts = 2 * shuffle_partitions(docs)
    shared = spark.sparkContext.broadcast(frequent)  # MOST_FREQUENT numbers at most

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            for ids, text, shingle, n in _slices(batch):
                doc = ids.to_numpy(zero_copy_only=False)
                known = ids.is_valid().to_numpy(zero_copy_only=False)
                same = _per_text(mixed(shingle ^ np.uint64(0x1357)), text, n, np.add)
                by = np.lexsort((doc, same))
                least = np.zeros(n, dtype=bool)
                least[by[np.append(True, same[by][1:] != same[by][:-1])]] = True
                use = (known & least)[text]
                t, key = sketch_blocks(text[use], shingle[use], shared.value, n)
                part = ((key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(int)
                order = np.argsort(part, kind="stable")
                part, key, sent = part[order], key[order], doc[t[order]].astype(np.int64)
                size = np.bincount(text, minlength=n)[t[order]]
                cuts = np.append(
                    np.flatnonzero(np.append(True, part[1:] != part[:-1]))[: len(part)], len(part)
                )
                pairs = list(zip(cuts, cuts[1:]))
                offsets = pa.array([0, *[j for _, j in pairs]], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part[cuts[:-1]], pa.int32()),
                        pa.ListArray.from_arrays(offsets, pa.array(key.view(np.int64))),
                        pa.ListArray.from_arrays(offsets, pa.array(sent)),
                        pa.ListArray.from_arrays(offsets, pa.array(size.astype(np.int32))),
                    ],
                    names=["part", "keys", "docs", "sizes"],
                )
        release_memory()

    def agreeing(table: pa.Table) -> pa.Table:
        flat = lambda name: np.concatenate(
            [c.flatten().to_numpy() for c in table.column(name).chunks]
        )
        return _agreeing(flat("keys"), flat("docs"), flat("sizes"))

    def groups(table: pa.Table) -> pa.Table:
        return releasing(agreeing, table)

    sent = docs.select("doc_id", "text").mapInArrow(
        blocks, "part int, keys array<bigint>, docs array<bigint>, sizes array<int>"
    )
    return sent.groupBy("part").applyInArrow(groups, _GROUPS)


_GROUPS = "key bigint, doc_id bigint, size int, hub bigint"


def _agreeing(key: np.ndarray, doc: np.ndarray, size: np.ndarray) -> pa.Table:
    """The rows whose key more than one set has; hub is the least id with the key."""
    order = np.lexsort((size, doc, key))
    key, doc, size = key[order], doc[order], size[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    key, doc, size = key[new], doc[new], size[new]
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    count = np.diff(np.append(at, len(key)))
    keep = np.repeat(count > 1, count)
    return pa.table(
        {
            "key": pa.array(key[keep]),
            "doc_id": pa.array(doc[keep]),
            "size": pa.array(size[keep].astype(np.int32)),
            "hub": pa.array(np.repeat(doc[at], count)[keep]),
        }
    )


def _open(groups: DataFrame, found: DataFrame) -> DataFrame:
    """Members (key, hub, a, size, c, out) of the groups that more than one component has;
    ``out`` are those outside the group's largest one. Both tables are stored."""
    of = found.select(F.col("id").alias("a"), "component")
    members = groups.select("key", "hub", F.col("doc_id").alias("a"), "size").join(
        broadcast_if_small(of), "a", "left"
    )
    members = members.select("key", "hub", "a", "size", F.coalesce("component", "a").alias("c"))

    def still(table: pa.Table) -> pa.Table:
        release_memory()
        key, c = (table.column(x).to_numpy() for x in ("key", "c"))
        order = np.lexsort((c, key))
        key, c = key[order], c[order]
        new = np.append(True, key[1:] != key[:-1])[: len(key)]
        run = np.flatnonzero(new | np.append(True, c[1:] != c[:-1])[: len(key)])
        length = np.diff(np.append(run, len(key)))
        group = np.cumsum(new)[run] - 1
        groups = int(new.sum())
        largest = np.zeros(groups, dtype=np.int64)
        by = np.argsort(length, kind="stable")
        largest[group[by]] = c[run[by]]
        several = np.bincount(group, minlength=groups) > 1
        at = np.cumsum(new) - 1
        table = table.take(pa.array(order[several[at]]))
        return table.append_column("out", pa.array((c != largest[at])[several[at]]))

    parted = members.withColumn(
        "part", F.pmod(F.xxhash64("key"), F.lit(2 * shuffle_partitions(groups)))
    )
    several = parted.groupBy("part").applyInArrow(still, f"part bigint, {_MEMBER}").drop("part")
    return in_tasks_of(several, groups.count(), _TASK_MEMBERS)


def _often_met(members: DataFrame) -> DataFrame:
    """Members that are in as many open groups as a link to another component takes.

    A partner has at least 3/4 of the set's size, and both lie in every group they agree
    on; so a set in fewer groups than the least partner would need has no such link. Texts
    that share a passage and little else go here. ``members`` is stored.
    """
    least = F.expr("(3 * size + 3) div 4 div 12 + 1")  # needed_agreements of the least partner
    often = members.groupBy("a").agg(F.count("*").alias("n"), F.min("size").alias("size"))
    often = often.where(F.col("n") >= least).select("a")
    often = written(in_tasks_of(often, members.count(), _TASK_ROWS), "often")
    return members.join(broadcast_if_small(often), "a", "left_semi")


_MEMBER = "key bigint, hub bigint, a bigint, size int, c bigint, out boolean"


def _celled(members: DataFrame) -> DataFrame:
    """Members (key, hub, a, size, c, out) dealt by hashes into cells of about _MEMBERS on
    either side.

    A key with few members is a cell, in which all pairs meet (``side`` is -1). Of others
    every block of members meets every block of those outside, on the two sides of a cell; a
    pair of two that are outside may meet twice. Only keys with many members are counted
    beforehand, so the table that says how they are cut is small.
    """
    sizes = members.groupBy("key").agg(
        F.count("*").alias("n"), F.greatest(F.count_if("out"), F.lit(1)).alias("m")
    )
    # At most one row for _MEMBERS members.
    large = written(sizes.where(F.col("n") > _MEMBERS), "large")
    cut = lambda n: F.coalesce(F.ceil(F.col(n) / _MEMBERS), F.lit(1)).cast("long")
    held = members.join(broadcast_if_small(large), "key", "left").select(
        "key", "hub", "a", "size", "c", "out", cut("n").alias("blocks"), cut("m").alias("others")
    )
    single = F.col("blocks") == 1
    own = F.pmod(F.xxhash64("a"), F.col("blocks"))
    mine = F.pmod(F.xxhash64("a", F.lit(1)), F.col("others"))

    def cell(i, j):
        return F.when(single, F.col("key")).otherwise(F.xxhash64("key", i, j))

    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    side = lambda k: F.when(single, F.lit(-1)).otherwise(F.lit(k)).alias("side")
    inside = held.select("*", F.explode(upto("others")).alias("other")).select(
        cell(own, F.col("other")).alias("key"), "hub", "a", "size", "c", side(0)
    )
    crossing = (
        held.where(~single & F.col("out"))
        .select("*", F.explode(upto("blocks")).alias("block"))
        .select(cell(F.col("block"), mine).alias("key"), "hub", "a", "size", "c", side(1))
    )
    return inside.union(crossing)


class _Sketches:
    """Bit sketches of several widths, held at every width that one of them has."""

    def __init__(self, sketches: list[bytes]):
        self._width = np.array([len(x) // 8 for x in sketches], dtype=np.int64)
        own = {
            w: np.frombuffer(
                b"".join(sketches[i] for i in np.flatnonzero(self._width == w)), np.uint64
            ).reshape(-1, w)
            for w in np.unique(self._width).tolist()
        }
        self._at = {}
        for w in own:
            rows = np.flatnonzero(self._width >= w)
            table = np.empty((len(rows), w), dtype=np.uint64)
            for v in own:
                if v >= w:
                    table[self._width[rows] == v] = _folded(own[v], w)
            place = np.full(len(sketches), -1)
            place[rows] = np.arange(len(rows))
            self._at[w] = table, place

    def near(self, x: np.ndarray, y: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether the pairs' sketches allow a link: at the least width first, and what that
        leaves at the smaller of the two widths. A narrow sketch of a large set is as far
        from any other, and would let all large sets pass."""
        keep = np.ones(len(x), dtype=bool)
        common = np.minimum(self._width[x], self._width[y])
        for w, (table, place) in sorted(self._at.items()):
            narrowest = w == min(self._at)
            rows = np.flatnonzero(keep if narrowest else keep & (common == w))
            step = max(1, 1_600_000 // w)
            for k in range(0, len(rows), step):
                at = rows[k : k + step]
                i, j = x[at], y[at]
                distance = np.bitwise_count(table[place[i]] ^ table[place[j]]).sum(
                    axis=1, dtype=np.int64
                )
                keep[at] = distance * 7 <= sizes[i] + sizes[j]
        return keep


def _across(cells: DataFrame, summaries: DataFrame) -> DataFrame:
    """Pairs a, b of different components that agree as often as linked sets have to, and
    whose bit sketches allow a link.

    ``cells`` comes from ``_celled``. Cells whose least members are the same lie in one part,
    as they name the same pairs again and again: a pair is counted there, its sketches come
    there once for each document, those of large sets at their full width, and a pair that
    they rule out never leaves the part.
    """

    def pairs(table: pa.Table, sketches: pa.Table) -> pa.Table:
        release_memory()
        column = lambda name: table.column(name).to_numpy()
        order = np.lexsort((column("size"), column("key")))
        key, a, c, size, side = (column(x)[order] for x in ("key", "a", "c", "size", "side"))
        ids, place = np.unique(a, return_inverse=True)
        known = np.argsort(sketches.column("id").to_numpy())
        sketch = _Sketches(sketches.column("sketch").take(pa.array(known)).to_pylist())
        sizes = np.zeros(len(ids), dtype=np.int64)
        sizes[place] = size
        first = np.append(True, key[1:] != key[:-1])[: len(key)]
        at = np.arange(len(key))
        position = at - np.maximum.accumulate(np.where(first, at, 0))
        found, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held, pending, apart = [], 0, 1

        def counted() -> tuple[np.ndarray, np.ndarray]:
            every = np.concatenate([found, *held])
            weight = np.ones(len(every), dtype=np.int64)
            weight[: len(found)] = counts
            different, at = np.unique(every, return_inverse=True)
            return different, np.bincount(at, weights=weight).astype(np.int64)

        # Members so far apart in their group, of all groups at once. Sizes rise in a
        # group, so a member that has become too large for one is so for all before it.
        while len(at := at[position[at] >= apart]):
            at = at[size[at - apart] * 4 >= size[at] * 3]
            other = at - apart
            meet = (c[at] != c[other]) & ((side[at] < 0) | (side[at] != side[other]))
            x, y = place[at[meet]], place[other[meet]]
            keep = sketch.near(x, y, sizes)
            x, y = x[keep], y[keep]
            held.append(np.maximum(x, y) * len(ids) + np.minimum(x, y))
            pending += len(held[-1])
            if pending > max(500_000, len(found)):
                found, counts = counted()
                held, pending = [], 0
            apart += 1
        found, counts = counted()
        high, low = found // max(len(ids), 1), found % max(len(ids), 1)
        return pa.table(
            {
                "a": pa.array(ids[high]),
                "b": pa.array(ids[low]),
                "n": pa.array(counts),
                "least": pa.array(np.minimum(sizes[high], sizes[low])),
            }
        )

    kind = "a bigint, b bigint, n bigint, least bigint"
    cells = written(_by_hub(cells), "cells")
    asked = cells.select(F.col("part").alias("place"), F.col("a").alias("id")).distinct()
    widest = F.coalesce("fine", "sketch").alias("sketch")
    held = asked.join(summaries.select(F.col("doc_id").alias("id"), widest), "id")
    named = cells.groupBy("part").cogroup(held.groupBy("place")).applyInArrow(pairs, kind)
    named = in_tasks_of(named, cells.count(), _TASK_MEMBERS // 5)
    enough = F.sum("n") >= F.expr("min(least) div 12 + 1")
    return named.groupBy("a", "b").agg(enough.alias("enough")).where("enough").select("a", "b")


#: Rows of one least member that go to one part.
_TOGETHER = 50_000


def _by_hub(cells: DataFrame) -> DataFrame:
    """Cells with the part they go to, by the hub of their key; one with very many rows is
    spread over several."""
    counts = cells.groupBy("hub").count().where(F.col("count") > _TOGETHER)
    # At most one row for _TOGETHER cells' rows.
    many = counts.select("hub", F.ceil(F.col("count") / _TOGETHER).alias("slices"))
    spread = F.pmod(F.xxhash64("key"), F.coalesce("slices", F.lit(1)))
    part = F.pmod(F.xxhash64("hub", spread), F.lit(4 * shuffle_partitions(cells)))
    return (
        cells.join(broadcast_if_small(written(many, "many")), "hub", "left")
        .withColumn("part", part)
        .drop("hub", "slices")
    )


def _alike(pairs: DataFrame, summaries: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes and sketches allow a similarity of 3/4.

    Both are stored tables. Pairs of large sets that the short sketches leave meet
    their long ones, so that few of those move.
    """

    def beside(pairs: DataFrame, column: str) -> DataFrame:
        side = lambda k: summaries.select(
            F.col("doc_id").alias(k),
            F.col("n_shingles").alias(f"n_{k}"),
            F.col(column).alias(f"sketch_{k}"),
            F.col("fine").isNotNull().alias(f"large_{k}"),
        )
        return pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            large = pa.compute.and_(batch.column("large_a"), batch.column("large_b"))
            distance = _distances(*(batch.column(f"sketch_{k}") for k in "ab"))
            out = batch.select(["a", "b"]).append_column("large", large)
            yield out.filter(pa.array(distance * 7 <= both))
        release_memory()

    sizes = F.least("n_a", "n_b") * 4 >= F.greatest("n_a", "n_b") * 3
    kind = "a bigint, b bigint, large boolean"
    met = in_tasks_of(beside(pairs, "sketch").where(sizes), pairs.count(), _TASK_ROWS // 4)
    left = written(met.mapInArrow(near, kind), "near")
    large = left.where("large")
    fine = in_tasks_of(beside(large, "fine"), large.count(), _TASK_PAIRS).mapInArrow(near, kind)
    return left.where("NOT large").union(fine).select("a", "b")


def _distances(x: pa.Array, y: pa.Array) -> np.ndarray:
    """Hamming distances of sketches row by row, at the smaller of their two widths."""
    width = np.array([[len(i), len(j)] for i, j in zip(x.to_pylist(), y.to_pylist())]) // 8
    out = np.zeros(len(x), dtype=np.int64)
    if not len(out):
        return out
    for w, v in np.unique(width, axis=0).tolist():
        rows = np.flatnonzero((width == (w, v)).all(axis=1))
        sides = [
            _folded(
                np.frombuffer(b"".join(c.take(pa.array(rows)).to_pylist()), np.uint64).reshape(
                    len(rows), -1
                ),
                min(w, v),
            )
            for c in (x, y)
        ]
        out[rows] = np.bitwise_count(sides[0] ^ sides[1]).sum(axis=1, dtype=np.int64)
    return out


def _linked(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (a, b) of which the whole texts have a similarity of at least 3/4.

    ``pairs`` is a stored table. Texts that pairs connect lie together, so that a text
    moves once and not with every pair; large clusters are cut into blocks, and a text
    moves to the pairs of blocks that ask for it.
    """
    cluster, number = components(pairs), pairs.count()

    def kept(rows: DataFrame, name: str) -> DataFrame:
        return written(in_tasks_of(rows, 2 * number, _TASK_ROWS), name)

    sizes = kept(
        cluster.groupBy("component").agg(
            F.ceil(F.count("*") / _CELL).cast("int").alias("blocks")
        ),
        "clusters",
    )
    place = kept(
        cluster.join(sizes, "component").select(
            "id", "component", "blocks",
            F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"),
        ),
        "places",
    )
    asked = (
        pairs.join(place.select(F.col("id").alias("a"), "component", F.col("block").alias("i")), "a")
        .join(place.select(F.col("id").alias("b"), F.col("block").alias("j")), "b")
        .select("component", "i", "j", "a", "b")
    )
    asked = kept(asked, "asked")
    cells = kept(
        asked.select("component", "i", "j", F.col("a").alias("doc_id"))
        .union(asked.select("component", "i", "j", "b"))
        .distinct(),
        "cells",
    )
    held = docs.join(broadcast_if_small(cells), "doc_id")

    def check(texts: pa.Table, asked: pa.Table) -> pa.Table:
        sets, ids = {}, texts.column("doc_id").to_pylist()
        for first, part in Texts.of(texts.column("text")).slices():
            text, shingle = shingle_sets(part)
            some = np.split(shingle, np.searchsorted(text, np.arange(1, len(part))))
            sets.update(zip(ids[first : first + len(part)], some))
        keep = []
        for a, b in zip(asked.column("a").to_pylist(), asked.column("b").to_pylist()):
            x, y = sets[a], sets[b]
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(both > 0 and 100 * both >= 75 * (len(x) + len(y) - both))
        return asked.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    key = ["component", "i", "j"]
    links = held.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(
        check, "a bigint, b bigint"
    )
    return in_tasks_of(links, number, _TASK_PAIRS)


def _candidates(
    docs: DataFrame, rows: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Summaries of the rows that can be linked, links to the least id with an equal set, and
    the groups of sets that agree on a block."""
    full = rows.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    equal = full.groupBy("set_a", "set_b", "n_shingles")
    least = equal.agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    number = rows.count()
    least = least.where("n > 1").drop("n")
    least = written(in_tasks_of(least, number, _TASK_ROWS), "equal")
    copies = (
        full.select("doc_id", "set_a", "set_b", "n_shingles")
        .join(least, ["set_a", "set_b", "n_shingles"])
        .select(F.col("doc_id").alias("a"), F.col("least").alias("b"))
        .where("a != b")
    )
    copies = written(in_tasks_of(copies, number, _TASK_ROWS), "copies")
    groups = block_groups(docs, frequent_shingles(docs, number))
    return full, copies, written(in_tasks_of(groups, number, _TASK_TEXTS), "groups")


def _one_text_each(docs: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Documents with an id per set, and the ids of those that had one doc_id in common.

    A doc_id with several sets is taken apart: each text gets a hash as its id, told from
    other ids as 64-bit hashes are. Where there is none, nothing changes.
    """
    several = (
        rows.where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(
            F.min("set_a").alias("a"), F.max("set_a").alias("b"),
            F.min("n_shingles").alias("c"), F.max("n_shingles").alias("d"),
        )
        .where("a != b OR c != d")
        .select(F.col("doc_id").alias("shared_id"))
    )
    several = written(in_tasks_of(several, rows.count(), _TASK_ROWS), "several")
    if several.isEmpty():
        return docs, None
    apart = docs.join(
        broadcast_if_small(several), F.col("doc_id") == F.col("shared_id"), "left"
    ).select(
        F.when(F.col("shared_id").isNotNull(), F.xxhash64("doc_id", "text"))
        .otherwise(F.col("doc_id"))
        .alias("doc_id"),
        "text",
        "shared_id",
    )
    names = written(
        apart.where("shared_id IS NOT NULL").select("doc_id", "shared_id").distinct(), "names"
    )
    return apart.select("doc_id", "text"), names


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    Texts are linked if 100 * |intersection| >= 75 * |union| of their sets of five-word
    shingles. Texts without words are linked with nothing. ``component_id`` is the least
    doc_id reachable; rows with one doc_id are one node, also where their texts differ, and
    rows without a doc_id are linked with nothing and have no component. No rows give no
    rows.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = written(shingle_summaries(docs), "sets")
    apart, names = _one_text_each(docs, rows)
    if names is None:
        found = _components_of(docs, rows)
        ids = rows.select("doc_id", "n_shingles")
    else:
        # Texts of one doc_id belong together; the least doc_id names the component.
        found = _components_of(apart, written(shingle_summaries(apart), "sets"), names)
        named = found.join(names, F.col("id") == names["doc_id"], "left").select(
            F.coalesce("shared_id", "id").alias("id"), "component"
        )
        least = named.groupBy("component").agg(F.min("id").alias("least"))
        found = (
            named.distinct().join(least, "component").select("id", F.col("least").alias("component"))
        )
        ids = rows.select("doc_id", "n_shingles")
    return ids.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def _components_of(
    docs: DataFrame, rows: DataFrame, names: DataFrame | None = None
) -> DataFrame:
    """id, component of the documents that are linked with others."""
    full, copies, groups = _candidates(docs, rows)
    counted = (
        groups.where("doc_id != hub")
        .select(F.col("doc_id").alias("a"), F.col("hub").alias("b"))
        .distinct()
    )
    once = full.select("doc_id", "n_shingles", "sketch", "fine").dropDuplicates(["doc_id"])
    number = rows.count()
    once = written(in_tasks_of(once, number, _TASK_TEXTS), "once")
    whole = docs.where(F.col("doc_id").isNotNull())

    def joined(found: DataFrame, pairs: DataFrame) -> DataFrame:
        """Components after testing more pairs."""
        # Stored, as tasks that go on with them would each hold two Python workers.
        links = written(_linked(written(_alike(pairs, once), "alike"), whole), "linked")
        stars = found.where("id != component").toDF("a", "b")
        return written(components(stars.union(links)), "components")

    start = copies.select(F.col("a").alias("id"), F.col("b").alias("component"))
    if names is not None:
        same = names.groupBy("shared_id").agg(F.min("doc_id").alias("least"))
        tied = names.join(same, "shared_id").where("doc_id != least")
        start = start.union(tied.select("doc_id", "least"))
    found = joined(start, written(in_tasks_of(counted, number, _TASK_TEXTS), "met"))
    members = written(_open(groups, found), "open")
    if members.isEmpty():
        return found
    across = _across(_celled(written(_often_met(members), "left")), once)
    return joined(found, written(across, "across"))


def linked_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links of every row: every link is found.

    ``near_duplicates`` tests what the components need; here every candidate pair of
    different sets is tested once. ``n_links`` is the number of other documents that a
    document is linked with, documents with an equal set included. A doc_id is expected
    to have one text; rows without a doc_id or words have no links. Members of a key are
    paired in blocks, so that many of them are spread over tasks.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = written(shingle_summaries(docs), "sets")
    full, copies, groups = _candidates(docs, rows)
    least = copies.groupBy("a").agg(F.min("b").alias("least"))
    sets = written(
        full.select("doc_id").distinct()
        .join(least, F.col("doc_id") == F.col("a"), "left")
        .select("doc_id", F.coalesce("least", "doc_id").alias("least")),
        "least",
    )
    weights = written(sets.groupBy("least").agg(F.count("*").alias("weight")), "weights")
    members = written(
        groups.join(sets, "doc_id")
        .select("key", "hub", F.col("least").alias("a"), "size")
        .distinct()
        .withColumn("c", F.col("a"))
        .withColumn("out", F.lit(True)),
        "members",
    )
    cells = _celled(members)
    once = written(
        full.select("doc_id", "n_shingles", "sketch", "fine").dropDuplicates(["doc_id"]), "once"
    )
    whole = docs.where(F.col("doc_id").isNotNull())
    across = written(_across(cells, once), "across")
    alike = written(_alike(across, once), "alike")
    links = written(_linked(alike, whole), "linked")
    found = components(links.union(copies)).withColumnRenamed("id", "doc_id")
    near = (
        links.union(links.select("b", "a"))
        .join(weights.select(F.col("least").alias("b"), "weight"), "b")
        .groupBy(F.col("a").alias("least"))
        .agg(F.sum("weight").alias("near"))
    )
    degrees = sets.join(weights, "least").join(near, "least", "left").select(
        "doc_id", (F.col("weight") - 1 + F.coalesce("near", F.lit(0))).alias("n_links")
    )
    return (
        rows.select("doc_id", "n_shingles")
        .join(found, "doc_id", "left")
        .join(degrees, "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component", "doc_id").alias("component_id"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
        )
    )
