import random
import zlib

import numpy as np
import pytest

from fleetstream.llm import packing, token_files
from fleetstream.llm.queries import vocabulary
from fleetstream.llm.storage import written
from fleetstream.llm.tokenizing import TextTokenizer

BYTES, WORDS = "byte_bpe_50k.json", "word_bpe_49k.json"


def _library(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary(name))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def _odd_texts(number):
    rng = random.Random(1)
    pieces = list(" \n\t  ,aAbB1½'!.,;é́İ\x00\x1c\x1fß\xa0　漢😀sS") + [
        "'s", "'S", "<|endoftext|>", "<|EndOfText|>", "<|startoftext|>", "<|endof", "don't", "  ", "word", "Word.", " a. b? ", "\r\n",
    ]
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(0, 40))) for _ in range(number)]


@pytest.mark.parametrize("name", [BYTES, WORDS])
@pytest.mark.parametrize("remembered", [5, 100_000])
def test_same_ids_as_the_library(name, remembered, real):
    ids = _library(name)
    texts = [None, "", *_odd_texts(3_000), *[t for _, t in real[:30]]]
    own = TextTokenizer(vocabulary(name), remembered)
    for at in range(0, len(texts), 50):
        part = texts[at : at + 50]
        for text, packed in zip(part, own.packed(part)):
            assert list(np.frombuffer(packed, "<u4")) == ids(text), text


@pytest.mark.parametrize("name", [BYTES, WORDS])
def test_unseen_pieces_go_through_the_library_together(name):
    ids = _library(name)
    own, taken = TextTokenizer(vocabulary(name)), []
    encoded = own._encoded
    own._encoded = lambda pieces: taken.append(pieces) or encoded(pieces)
    texts = ["alpha bravo< |endoftext|> <|endoftext charlie|>", "delta< echo"]
    for text, packed in zip(texts, own.packed(texts)):
        assert list(np.frombuffer(packed, "<u4")) == ids(text)
    assert [len(pieces) for pieces in taken] == [1]
    own.packed(texts)
    assert len(taken) == 2 and taken[1] == []


@pytest.mark.parametrize("name", [BYTES, WORDS])
def test_unseen_words_go_through_the_library_without_tokens_between(name, real):
    ids = _library(name)
    own, taken = TextTokenizer(vocabulary(name)), []
    encoded = own._encoded
    own._encoded = lambda pieces: taken.append(pieces) or encoded(pieces)
    texts = ["alpha bravo's charlie, don't 12ab echo9 x\u0300y ἀλφα 漢字 delta", *[t for _, t in real[:30]]]
    for text, packed in zip(texts, own.packed(texts)):
        assert list(np.frombuffer(packed, "<u4")) == ids(text)
    assert all(len(pieces) < 2 for pieces in taken)
    assert sum(piece.count("<|") for pieces in taken for piece in pieces) < len(own._new) / 10
    own = TextTokenizer(vocabulary(name))
    # As if the borders of words could not be told: then pieces are encoded apart.
    own._border[:] = False
    for text, packed in zip(texts, own.packed(texts)):
        assert list(np.frombuffer(packed, "<u4")) == ids(text)


def test_token_counts_and_wide_ranks(spark):
    def row(*ids):
        wide = max(ids) > 0xFFFF
        return (1, bytes([4 if wide else 2]) + np.array(ids, "<u4" if wide else "<u2").tobytes())

    rows = [row(2, 5, 5), row(70_000, 2), row(2)] * 70
    got = token_files.frequencies(spark.createDataFrame(rows, "doc_id long, ids binary").coalesce(1))
    assert {r["id"]: r["n"] for r in got.collect()} == {2: 210, 5: 140, 70_000: 70}


def test_ranks_come_back():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 4, 5, 1001):
        ranks = rng.integers(0, 2**32, n) >> rng.integers(0, 32, n)
        control, data = token_files.encode_ranks(ranks)
        assert len(control) == -(-n // 4)
        assert (token_files.decode_ranks(control, data, n) == ranks).all()
    assert len(token_files.encode_ranks(np.array([0, 255, 256, 65536, 2**24]))[1]) == 11


def _rows(real):
    return real + [(50_000, None), (50_001, ""), (-3, "first"), (50_002, "long text " * 9_000)]


def test_token_files_round_trip(documents, real):
    rows, ids = _rows(real), _library(WORDS)
    df = documents(rows).repartition(5)
    stored = token_files.stored_tokens(df, vocabulary(WORDS))
    got = {r.doc_id: r for r in stored.collect()}
    crc = {r.doc_id: r.ids_crc32 for r in token_files.digests(stored).collect()}
    start = 0
    for d, t in sorted(rows):
        want = np.array([*ids(t), 2], dtype="<u4")
        assert got[d].ids == want.tobytes() and got[d].n_tokens == len(want)
        assert got[d].start == start and crc[d] == zlib.crc32(want.tobytes())
        start += len(want)


def test_token_files_repeated_null_and_none(documents):
    rows = [(1, "a b"), (1, "a b"), (None, "c"), (0, "d")]
    found = token_files.stored_tokens(documents(rows), vocabulary(WORDS)).collect()
    order = sorted((r.start, r.doc_id, r.n_tokens) for r in found)
    assert order == [(0, None, 2), (2, 0, 2), (4, 1, 3), (7, 1, 3)]
    assert token_files.stored_tokens(documents([]), vocabulary(WORDS)).count() == 0


def test_frequent_ids_have_small_ranks(spark, documents, real, tmp_path):
    ids = written(token_files.token_ids(documents(real), vocabulary(WORDS)), "ids")
    token_files.write_token_files(ids, f"{tmp_path}/store")
    order = {r["id"]: r["rank"] for r in spark.read.parquet(f"{tmp_path}/store/vocabulary").collect()}
    counts = {r["id"]: r["n"] for r in token_files.frequencies(ids).collect()}
    assert set(order) == set(counts)
    assert [order[i] for i, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))] == list(range(len(order)))


def _check_packing(rows, ids, pieces, capacity):
    got = {}
    for p in pieces:
        got.setdefault(p.doc_id, []).append(p)
    for d, t in rows:
        want = np.array([*ids(t), 2], dtype="<u4")
        own = sorted(got[d], key=lambda p: p.piece)
        assert [p.piece for p in own] == list(range(len(own)))
        assert len(own) == -(-len(want) // capacity)
        assert all(p.length == capacity for p in own[1:])
        at = 0
        for p in own:
            assert p.start == at
            assert p.ids_crc32 == zlib.crc32(want[at : at + p.length].tobytes())
            at += p.length
        assert at == len(want)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing_round_trip(documents, real):
    rows = _rows(real)
    pieces = packing.pack_documents(documents(rows), vocabulary(BYTES)).collect()
    number = _check_packing(rows, _library(BYTES), pieces, 1024)
    total = sum(p.length for p in pieces)
    assert number <= -(-total // 1024) * 1.02 + 1


def _best_fit(lengths, capacity):
    free = []
    for x in sorted(lengths, reverse=True):
        fits = [k for k, f in enumerate(free) if f >= x]
        if fits:
            free[min(fits, key=lambda k: free[k])] -= x
        else:
            free.append(capacity - x)
    return sorted(free)


@pytest.mark.parametrize("capacity", [1, 7, 100, 1000])
def test_plan_is_best_fit_decreasing(capacity):
    rng = random.Random(capacity)
    for _ in range(20):
        lengths = [rng.randint(1, capacity) for _ in range(rng.randrange(0, 300))]
        lengths += [rng.randint(1, capacity)] * rng.randrange(0, 200)
        histogram = {s: lengths.count(s) for s in set(lengths)}
        free, ranks = {}, {}
        for size, rank, count, first, offset in packing.plan_best_fit(histogram, capacity):
            assert rank == ranks.get(size, 0)
            ranks[size] = rank + count
            for b in range(first, first + count):
                assert free.get(b, capacity) == capacity - offset
                free[b] = capacity - offset - size
        assert ranks == histogram and sorted(free.values()) == _best_fit(lengths, capacity)


def test_plan_size_does_not_grow_with_the_counts():
    rng = random.Random(4)
    small = {s: rng.randint(1, 9) for s in range(1, 1025)}
    plans = [
        len(packing.plan_best_fit({s: n * f for s, n in small.items()}, 1024)) for f in (100, 10_000)
    ]
    assert plans[1] < 2 * plans[0] and plans[1] < 100_000


def test_packing_other_columns_repeated_rows_none(spark, documents):
    df = spark.createDataFrame([("k", 3, 1), ("k", 3, 1), ("l", 2, 2)], "offset_ string, length long, _rank int")
    got = packing.best_fit(df, 5).collect()
    assert sorted((r.sequence_id, r.offset, r.length) for r in got)[0][1] == 0
    assert len(got) == 3 and len({r.sequence_id for r in got}) == 2
    assert packing.pack_documents(documents([]), vocabulary(BYTES)).count() == 0
    with pytest.raises(ValueError):
        packing.best_fit(spark.createDataFrame([(6,)], "length long"), 5)
