import random

import numpy as np
import pytest

from fleetstream.llm import substring_dedup, suffix_dedup
from fleetstream.llm.windows import doubled, level_lengths, sliding_min
from tests.llm import brute


def _found(df, *columns):
    return sorted((tuple(r[c] for c in ("doc_id", *columns)) for r in df.collect()), key=str)


def _words(df):
    return _found(
        substring_dedup.without_repeats(df), "n_words", "n_removed", "kept_sha256"
    )


def _bytes(df, **sizes):
    return _found(
        suffix_dedup.without_repeats(df, **sizes),
        "n_bytes", "n_removed", "n_spans", "kept_sha256",
    )


def _odd_rows():
    rng = random.Random(3)
    line = " ".join(rng.choice(["ab", "cd", "é"]) for _ in range(60))
    rows = [
        (i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 60)))) for i in range(60)
    ]
    # Periodic, empty and very long texts, copies, a passage that many share.
    rows += [(500, None), (501, ""), (502, "x " * 5000), (503, "é\n\t" * 400), (504, "x " * 5000)]
    rows += [(600 + i, f"own{i} {line} end{i} " * 2) for i in range(40)]
    rows += [(700, "q" * 700_000), (701, " \n\t ")]
    return rows


def test_windows_by_hand():
    h = np.arange(1, 40, dtype=np.uint64) ** 2
    assert level_lengths(7, 13) == [7, 13]
    assert level_lengths(25, 200) == [25, 50, 100, 200]
    assert doubled(h, 1, 2)[3] == doubled(h[3:5], 1, 2)[0]
    assert list(sliding_min(np.array([5, 3, 4, 9, 1]), 3)) == [3, 3, 1]


def test_words_like_brute_force(documents):
    rows = _odd_rows()
    assert _words(documents(rows).repartition(7)) == brute.substrings(rows)


def test_bytes_like_brute_force(documents):
    rows = [r for r in _odd_rows() if r[0] != 700]
    assert _bytes(documents(rows).repartition(7)) == brute.bytes_repeated(rows)
    assert _bytes(documents(rows[-50:]), length=37, q=5) == brute.bytes_repeated(rows[-50:], 37)


def test_one_letter_text_longer_than_a_piece(documents):
    (row,) = _bytes(documents([(700, "q" * 700_000)]))
    assert row[1:4] == (700_000, 700_000, 1)


def test_real_documents(documents, real):
    df = documents(real)
    assert _words(df) == brute.substrings(real)
    some = real[:120] + [(9_000 + d, t) for d, t in real[:20]]
    assert _bytes(documents(some)) == brute.bytes_repeated(some)


def test_same_result_for_any_partitions(spark, documents, real):
    df = documents(real)
    want = _words(df)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        assert _words(df.repartition(31)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_repeated_rows_and_null_ids(documents):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(5, text), (5, text), (None, text), (7, text + " more")]
    assert _words(documents(rows)) == brute.substrings(rows)
    assert _bytes(documents([(1, "z" * 250), (1, "z" * 250)]))[0][2] == 250


@pytest.mark.parametrize("name", ["bucket", "part", "flags", "_0", "a b"])
def test_other_columns_stay(spark, name):
    text = " ".join(f"w{k}" for k in range(20))
    df = spark.createDataFrame([(1, text, 10), (2, text, 20)], f"doc_id long, text string, `{name}` int")
    got = {r["doc_id"]: (r[name], r["kept_text"]) for r in substring_dedup.without_repeats(df).collect()}
    assert got == {1: (10, text), 2: (20, "")}


def test_empty_table(documents):
    empty = documents([])
    assert substring_dedup.without_repeats(empty).count() == 0
    assert suffix_dedup.without_repeats(empty).count() == 0


def test_text_moves_once(documents, real):
    df = substring_dedup.without_repeats(documents(real))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") >= 2
