"""Groups of sets that agree on many blocks, and ids with several texts."""

import random

import numpy as np
import pyarrow as pa
import pytest

from fleetstream.llm import jaccard
from tests.llm import brute


def found(df):
    return sorted(
        {(r.doc_id, r.component_id) for r in jaccard.near_duplicates(df).collect()}, key=str
    )


@pytest.mark.parametrize("parts", [1, 2, 3])
def test_one_id_with_two_texts(documents, parts):
    """All texts of a doc_id are one node, whatever is read together."""
    a, b = (" ".join(f"{x}{k}" for k in range(40)) for x in "ab")
    rows = [(7, a), (7, b), (3, a + " x"), (5, b + " x"), (9, "quite other words here now"), (7, a),
            (11, "alone"), (11, "apart"), (12, None), (12, a + " y")]
    got = found(documents(rows).repartition(parts))
    assert got == sorted([(3, 3), (5, 3), (7, 3), (9, 9), (11, 11), (12, 3)], key=str)


def test_ids_with_texts_are_told_from_other_ids(documents):
    rows = [(1, "one two three four five six"), (1, "seven"), (2, "seven"), (2, "eight"), (3, "eight"),
            (4, None), (4, ""), (None, "eight"), (None, "seven")]
    got = found(documents(rows))
    assert got == sorted([(1, 1), (2, 1), (3, 1), (4, 4), (None, None)], key=str)
    counts = {(r.doc_id, r.n_shingles) for r in jaccard.near_duplicates(documents(rows)).collect()}
    assert counts == {(1, 2), (1, 1), (2, 1), (3, 1), (4, 0), (None, 1)}


def edited(rng, base, most):
    words = list(base)
    for k in rng.sample(range(len(words)), rng.randrange(most)):
        words[k] = f"x{rng.randrange(10**9)}"
    return " ".join(words)


@pytest.mark.parametrize("members", [16, 512])
def test_a_family_whose_middle_is_not_the_least_id(documents, monkeypatch, members):
    """Copies edited so much that few are linked with the least one; groups in one cell
    and in many, one hub's in one part and in many."""
    monkeypatch.setattr(jaccard, "_MEMBERS", members)
    monkeypatch.setattr(jaccard, "_TOGETHER", 5 * members)
    rng = random.Random(members)
    rows = []
    for family, size in ((0, 120), (1, 40), (2, 9)):
        base = [f"f{family}w{k}" for k in range(90)]
        rows += [(1000 * family + i, edited(rng, base, 7)) for i in range(size)]
    rows += [(9000 + i, " ".join(f"f0w{k}" for k in range(i, 60 + i))) for i in range(25)]
    want = brute.near_duplicates(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(documents(rows).repartition(5)).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) > 5


def test_cells_hold_every_pair_once_or_twice(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "_MEMBERS", 4)
    rng = random.Random(2)
    rows = [(k, a, 10, 0 if rng.random() < 0.6 else 100 + a % 7) for k in range(3) for a in range(3 + 9 * k)]
    members = spark.createDataFrame(rows, "key long, a long, size int, c long")
    members = members.selectExpr("key", "0L AS hub", "a", "size", "c", "c != 0 AS out")
    cells = {}
    for r in jaccard._celled(members).collect():
        cells.setdefault(r.key, []).append((r.a, r.c, r.side))
    assert max(len(c) for c in cells.values()) < 21 == max(k for k in (3, 12, 21))
    met = set()
    for cell in cells.values():
        for a, c, s in cell:
            for b, d, t in cell:
                if a < b and c != d and (s < 0 or s != t):
                    met.add((a, b))
    want = {(a, b) for k, a, _, c in rows for l, b, _, d in rows if k == l and a < b and c != d}
    assert met == want


def test_sketches_of_large_sets_bound_the_difference_and_tell_others_apart():
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 2**63, 6_000).astype(np.uint64))
    near = np.unique(np.append(base[300:], rng.integers(0, 2**63, 900).astype(np.uint64)))
    sets = [base, near, *(rng.integers(0, 2**63, n).astype(np.uint64) for n in (6_000, 4_700, 9))]
    sets = [np.unique(x) for x in sets]
    text = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    found = jaccard._bit_sketches(text, np.concatenate(sets), len(sets))
    assert [len(x) * 64 for x in found] == [8192, 8192, 8192, 4096, jaccard.SKETCH_BITS]
    blobs = [x.tobytes() for x in found]
    pairs = [(i, j) for i in range(len(sets)) for j in range(len(sets))]
    got = jaccard._distances(*(pa.array([blobs[p[k]] for p in pairs], pa.binary()) for k in (0, 1)))
    for (i, j), distance in zip(pairs, got):
        apart = len(np.setxor1d(sets[i], sets[j]))
        assert distance <= apart and (distance - apart) % 2 == 0
        if 4 in (i, j) or i == j:
            continue
        alike = distance * 7 <= len(sets[i]) + len(sets[j])
        assert alike == ({i, j} == {0, 1})
    none = pa.array([], pa.binary())
    assert len(jaccard._distances(none, none)) == 0


def test_large_unlike_sets_are_ruled_out_where_they_meet(spark):
    """Sets of more shingles than a narrow sketch has bits, which agree on many blocks."""
    rng = np.random.default_rng(8)
    base = np.unique(rng.integers(0, 2**63, 2_400).astype(np.uint64))
    sets = [base, base[100:], *(rng.integers(0, 2**63, n).astype(np.uint64) for n in (2_400, 2_300, 7_000, 20))]
    sets = [np.unique(x) for x in sets]
    text = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    words = jaccard.SKETCH_BITS // 64
    summaries = spark.createDataFrame(
        [
            (i, bytearray(jaccard._folded(x[None], words).tobytes()),
             bytearray(x.tobytes()) if len(x) > words else None)
            for i, x in enumerate(jaccard._bit_sketches(text, np.concatenate(sets), len(sets)))
        ],
        "doc_id long, sketch binary, fine binary",
    )
    members = spark.createDataFrame(
        [(k, 0, i, len(x), i, -1) for k in range(300) for i, x in enumerate(sets)],
        "key long, hub long, a long, size int, c long, side int",
    )
    assert [tuple(r) for r in jaccard._across(members, summaries).collect()] == [(1, 0)]
