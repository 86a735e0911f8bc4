"""Windows of texts that occur in other places too: the work of both substring dedups.

Each window of ``length`` units is stood for by the least hash among its windows of
``first`` units (its key), the first of them where several are equal. Neighbouring windows
with the same one form a run, and equal windows have equal keys wherever they are. Texts lie in buckets. Every bucket sends each
different (key, run) once, however many of its texts have it, to the part that its key
belongs to; so a passage in a third of all texts is one entry per bucket there.

* A key that occurs once is no candidate: no window of its runs is repeated.
* A run that is there elsewhere, whole, needs no more work: all its windows are repeated.
* Where different runs share a key, the first place of each run sends the hashes of its
  windows at the full length, and these are counted alone.

Parts answer with one byte per entry, in the order in which the bucket sent them, so no
key travels twice. Buckets find runs anew in each pass; a bucket's texts are sorted first,
which makes every pass find them alike, also when a lost executor's tasks run again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from fleetstream.llm.storage import releasing, shuffle_partitions
from fleetstream.llm.windows import (
    PIECE_UNITS,
    Sums,
    Texts,
    Units,
    doubled,
    level_lengths,
    mixed,
    sliding_min,
)

_COVERED, _ASKED = 1, 2
_NO_ID = 2**63 - 1
#: The slice is that of windows, or -1 for the runs of a whole bucket.
_SENT = "bucket int, slice int, part int, entries binary"
_ANSWER = "bucket int, slice int, part int, flags binary"
#: Bits of a key; the others of a 64-bit number have its place in a piece of text.
_KEY_BITS = 44


@dataclass(frozen=True)
class Windows:
    """What is looked for.

    ``earlier``: repeated means that a text with a smaller doc_id has the window;
    otherwise that the window begins at any other place.
    """

    units: Callable[[Texts], Units]
    first: int
    length: int
    earlier: bool


def _planes(*columns: np.ndarray) -> bytes:
    """64-bit columns byte by byte, so that bytes that are alike lie together."""
    return b"".join(
        np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()
        for c in columns
    )


def _columns(planes: bytes, count: int) -> list[np.ndarray]:
    raw = np.frombuffer(planes, dtype=np.uint8).reshape(count, 8, -1)
    return [np.ascontiguousarray(c.T).view("<u8").reshape(-1) for c in raw]


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a sorted table's row differs from the one before."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


@dataclass
class _Entries:
    """Different (a, b) in order, with the least doc and the count; of: entry per row."""

    a: np.ndarray
    b: np.ndarray
    doc: np.ndarray
    count: np.ndarray
    of: np.ndarray

    @classmethod
    def group(cls, a, b, doc) -> _Entries:
        order = np.lexsort((doc, b, a))
        a, b, doc = a[order], b[order], doc[order]
        new = _changes(a, b)
        at = np.flatnonzero(new)
        of = np.empty(len(order), dtype=np.int64)
        of[order] = np.cumsum(new) - 1
        return cls(a[at], b[at], doc[at], np.diff(np.append(at, len(a))), of)

    def dealt(self, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """The part of each entry, and the entries in the order of their parts.

        Keys are least hashes and thus small numbers, so they are hashed again.
        """
        high = mixed(self.a ^ np.uint64(0x7A5C)) >> np.uint64(32)
        part = (high * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        return part, np.argsort(part, kind="stable")

    def sent(self, bucket: int, slice_: int, parts: int) -> pa.Table:
        part, order = self.dealt(parts)
        part, columns = part[order], (self.a, self.b, self.doc.view(np.uint64), self.count)
        columns = [c[order] for c in columns]
        cuts = np.append(np.flatnonzero(_changes(part)), len(part))
        blobs = [_planes(*[c[i:j] for c in columns]) for i, j in zip(cuts, cuts[1:])]
        return pa.table(
            {
                "bucket": pa.array([bucket] * len(blobs), pa.int32()),
                "slice": pa.array([slice_] * len(blobs), pa.int32()),
                "part": pa.array(part[cuts[:-1]], pa.int32()),
                "entries": pa.array(blobs, pa.binary()),
            }
        )

    def answered(self, flags: np.ndarray, parts: int) -> np.ndarray:
        """Flags in the order in which entries were sent, as flags of the entries."""
        own = np.empty_like(flags)
        own[self.dealt(parts)[1]] = flags
        return own


@dataclass
class _Slice:
    """Consecutive texts of a bucket and the runs of windows [first, last] in them.

    Their units take many times the room of the texts, so they are made when needed.
    """

    texts: Texts
    first: np.ndarray
    last: np.ndarray
    key: np.ndarray
    run: np.ndarray
    doc: np.ndarray


@dataclass
class _Asked:
    """Windows of a slice by where they start, with their texts' ids."""

    starts: np.ndarray
    docs: np.ndarray
    entries: _Entries


class _Bucket:
    def __init__(self, table: pa.Table, what: Windows):
        self.what = what
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.bucket = table.column("bucket")[0].as_py()
        self.table = table.drop_columns(["bucket"])
        # Without a doc_id a text comes after all others.
        self.docs = table.column("doc_id").fill_null(_NO_ID).to_numpy().astype(np.int64)
        texts = Texts.of(table.column("text"))
        self.slices = [self._runs(k, t) for k, t in texts.slices()]
        joined = lambda name, kind: np.concatenate(
            [getattr(s, name) for s in self.slices] or [np.zeros(0)]
        ).astype(kind)
        self.entries = _Entries.group(
            joined("key", np.uint64), joined("run", np.uint64), joined("doc", np.int64)
        )

    def _runs(self, begin: int, texts: Texts) -> _Slice:
        units, what = self.what.units(texts), self.what
        found = []
        n = len(units.hashes) - what.length + 1
        for a in range(0, max(n, 0), PIECE_UNITS):
            z = min(a + PIECE_UNITS, n)
            hashes = units.hashes[a : z + what.length - 1]
            text = units.text[a : z + what.length - 1]
            sums = Sums(hashes)
            at = np.arange(len(hashes) - what.first + 1)
            place = np.uint64(64 - _KEY_BITS)
            short = sums.of(at, at + what.first) >> place << place | at.astype(np.uint64)
            least = sliding_min(short, what.length - what.first + 1)
            size = z - a
            inside = text[:size] == text[what.length - 1 :]
            new = np.ones(size, dtype=bool)
            new[1:] = (least[1:] != least[:-1]) | ~inside[:-1]
            first = np.flatnonzero(new & inside)
            ends = np.ones(size, dtype=bool)
            ends[:-1] = new[1:] | ~inside[1:]
            last = np.flatnonzero(ends & inside)
            key = least[first] >> place
            run = sums.of(first, last + what.length)
            found.append((first + a, last + a, key, run, self.docs[begin + text[first]]))
        empty = np.zeros(0, dtype=np.int64)
        columns = [np.concatenate(c) for c in zip(*found)] if found else [empty] * 5
        return _Slice(texts, *columns)

    def asked(self, flags: np.ndarray) -> Iterator[_Asked]:
        """Slice by slice, the windows whose hashes are asked for."""
        what, at = self.what, 0
        for s in self.slices:
            of = self.entries.of[at : at + len(s.first)]
            at += len(s.first)
            # The first place of a run speaks for it.
            mine = ((flags[of] & _ASKED) > 0) & (s.doc == self.entries.doc[of])
            first, count = s.first[mine], s.last[mine] - s.first[mine] + 1
            shift = np.repeat(np.cumsum(count) - count, count)
            starts = np.repeat(first, count) + np.arange(len(shift)) - shift
            ids = pairs = np.zeros(0, dtype=np.uint64)
            if len(starts):
                units, short = what.units(s.texts).hashes, what.first
                sums = Sums(units)
                every = np.arange(len(units) - short + 1)
                ids = sums.of(every, every + short)
                for longer in level_lengths(short, what.length)[1:]:
                    ids, short = doubled(ids, short, longer), longer
                ids, pairs = ids[starts], sums.of(starts, starts + short)
            docs = np.repeat(s.doc[mine], count)
            yield _Asked(starts, docs, _Entries.group(ids, pairs, docs))

    def repeated(self, flags: np.ndarray, window_flags: list[np.ndarray], parts: int):
        """Per slice its units, and which of them lie in a repeated window."""
        at = 0
        for s, asked, answered in zip(self.slices, self.asked(flags), window_flags):
            of = self.entries.of[at : at + len(s.first)]
            at += len(s.first)
            known = (flags[of] & _COVERED) > 0
            own = asked.entries.answered(answered, parts)
            hit = (own[asked.entries.of] & _COVERED) > 0
            if self.what.earlier:
                known |= s.doc > self.entries.doc[of]
                hit |= asked.docs > asked.entries.doc[asked.entries.of]
            units = self.what.units(s.texts)
            n = len(units.hashes)
            edge = np.bincount(s.first[known], minlength=n + 1)
            edge -= np.bincount(s.last[known] + self.what.length, minlength=n + 1)
            edge += np.bincount(asked.starts[hit], minlength=n + 1)
            edge -= np.bincount(asked.starts[hit] + self.what.length, minlength=n + 1)
            yield s.texts, units, np.cumsum(edge[:n]) > 0


def _flags(answers: pa.Table, windows: bool, slices: int) -> list[np.ndarray]:
    """The answers to a bucket's runs, or to the windows of each of its slices."""
    found = [[] for _ in range(slices)]
    for r in answers.to_pylist():
        if (r["slice"] >= 0) == windows:
            found[max(r["slice"], 0)].append((r["part"], r["flags"]))
    return [
        np.frombuffer(b"".join(x for _, x in sorted(rows)), dtype=np.uint8) for rows in found
    ]


def _answers(table: pa.Table, earlier: bool) -> pa.Table:
    """One byte per entry of a part."""
    blobs = table.column("entries").to_pylist()
    columns = [_columns(x, 4) for x in blobs]
    sizes = [len(c[0]) for c in columns]
    a, b, doc, count = (np.concatenate(c) for c in zip(*columns))
    doc = doc.view(np.int64)
    order = np.lexsort((doc, b, a))
    a, b, doc, count = a[order], b[order], doc[order], count[order]
    new = _changes(a, b)
    at = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    least = doc[at][group]
    if earlier:
        covered = doc > least
    else:
        covered = np.add.reduceat(count.astype(np.int64), at)[group] > 1
    key = np.cumsum(_changes(a)) - 1
    shared = np.bincount(key[at])[key] > 1
    flags = np.empty(len(order), dtype=np.uint8)
    flags[order] = covered * _COVERED + (shared & (doc == least)) * _ASKED
    cuts = np.cumsum([0, *sizes])
    return pa.table(
        {
            "bucket": table.column("bucket"),
            "slice": table.column("slice"),
            "part": table.column("part"),
            "flags": pa.array([flags[i:j].tobytes() for i, j in zip(cuts, cuts[1:])], pa.binary()),
        }
    )


def repeated_units(
    docs: DataFrame,
    what: Windows,
    rows: Callable[[Texts, Units, np.ndarray], pa.Table],
    schema: str,
) -> DataFrame:
    """All columns of ``docs`` and those of rows(texts, units, which are repeated).

    ``docs`` has doc_id and text. Every row is a text of its own, repeated rows too. The
    result of ``rows`` has a row per text; ``schema`` describes it.
    """
    # A bucket sends a row to each part, so neither should be many more than tasks.
    parts = buckets = shuffle_partitions(docs)
    # Renamed, as a table may have columns with any names.
    carried = {c: f"_{k}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    texts = docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int").alias("bucket"),
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        *[F.col(f"`{c}`").alias(new) for c, new in carried.items()],
    )
    result_type = T.StructType(
        texts.schema.fields[1:] + T.StructType.fromDDL(schema).fields
    )

    def runs(table: pa.Table) -> pa.Table:
        b = _Bucket(table, what)
        return b.entries.sent(b.bucket, -1, parts)

    def answer(table: pa.Table) -> pa.Table:
        return releasing(_answers, table, what.earlier)

    def windows_of(table: pa.Table, answers: pa.Table) -> pa.Table:
        b = _Bucket(table, what)
        flags = b.entries.answered(*_flags(answers, False, 1), parts)
        return pa.concat_tables(
            a.entries.sent(b.bucket, k, parts) for k, a in enumerate(b.asked(flags))
        )

    def made_of(table: pa.Table, answers: pa.Table) -> pa.Table:
        b = _Bucket(table, what)
        flags = b.entries.answered(*_flags(answers, False, 1), parts)
        windows = _flags(answers, True, len(b.slices))
        made = [rows(*x) for x in b.repeated(flags, windows, parts)]
        out = b.table
        for field in made[0].schema:
            chunks = [c for m in made for c in m.column(field.name).chunks]
            out = out.append_column(field, pa.chunked_array(chunks, field.type))
        return out

    def send_runs(table: pa.Table) -> pa.Table:
        return releasing(runs, table)

    def send_windows(table: pa.Table, answers: pa.Table) -> pa.Table:
        return releasing(windows_of, table, answers)

    def result(table: pa.Table, answers: pa.Table) -> pa.Table:
        return releasing(made_of, table, answers)

    by_bucket = texts.groupBy("bucket")
    first = by_bucket.applyInArrow(send_runs, _SENT).groupBy("part").applyInArrow(
        answer, _ANSWER
    )
    second = (
        by_bucket.cogroup(first.groupBy("bucket"))
        .applyInArrow(send_windows, _SENT)
        .groupBy("part")
        .applyInArrow(answer, _ANSWER)
    )
    done = by_bucket.cogroup(first.unionByName(second).groupBy("bucket")).applyInArrow(
        result, result_type
    )
    own = {new: c for c, new in carried.items()}
    return done.select(*[F.col(c).alias(own.get(c, c)) for c in done.columns])
