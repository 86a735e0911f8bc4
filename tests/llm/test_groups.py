import random

import numpy as np
import pytest

from fleetstream.llm import embeddings, jaccard
from fleetstream.llm.components import components, roots
from fleetstream.llm.windows import Texts
from tests.llm import brute


def test_roots():
    node, root = roots(np.array([5, 3, 9, 9]), np.array([3, 1, 8, 8]))
    assert dict(zip(node.tolist(), root.tolist())) == {1: 1, 3: 1, 5: 1, 8: 8, 9: 8}


def test_components_of_paths_stars_and_copies(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(300)] + [(2000, 1000 + i) for i in range(400)]
    links += [(7, 7), (None, 3), (50, None), (2000, 1000), (1000, 2000)]
    rng.shuffle(links)
    found = components(spark.createDataFrame(links, "a long, b long").repartition(11)).collect()
    got = {r.id: r.component for r in found}
    assert len(got) == len(found)
    assert {got[i] for i in range(301)} == {0} and {got[i] for i in range(1000, 1400)} == {1000}
    assert got[2000] == 1000 and len(got) == 301 + 401
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _families(seed, sizes=(1, 2, 3, 4, 5, 6, 7, 9, 12, 20, 40, 70, 120, 300)):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(50):
        base = [rng.choice(words) for _ in range(rng.choice(sizes))]
        for _ in range(rng.choice([1, 2, 3, 8, 20])):
            text = list(base)
            for _ in range(rng.randrange(0, len(text) // 25 + 2)):
                text[rng.randrange(len(text))] = rng.choice(words)
            joined = " ".join(text)
            rows.append((len(rows) * 7 % 9973, joined.upper() if rng.random() < 0.2 else joined))
    rng.shuffle(rows)
    return rows


def _near(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df).collect()}


def test_families_like_brute_force(documents):
    rows = _families(5) + [(20_000, None), (20_001, ""), (20_002, " \n")]
    assert _near(documents(rows).repartition(6)) == brute.near_duplicates(rows)


def test_shared_passage_brings_nobody_together(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "_LEAST_FREQUENT", 3)
    rng = random.Random(2)
    passage = " ".join(f"p{k}" for k in range(60))
    own = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    rows = [(i, f"{own(20)} {passage} {own(rng.choice([5, 60]))}") for i in range(120)]
    # Almost nothing but the passage: these are alike.
    rows += [(1000 + i, f"{passage} {own(2)}") for i in range(25)]
    assert _near(documents(rows)) == brute.near_duplicates(rows)


def test_one_group_of_many_near_copies(documents):
    rng = random.Random(3)
    base = [f"b{k}" for k in range(200)]
    rows = []
    for i in range(300):
        text = list(base)
        for k in rng.sample(range(200), 8):
            text[k] = f"x{rng.randrange(10**6)}"
        rows.append((i + 1, " ".join(text)))
    # The middle of the group has a greater id than all that it links.
    rows.append((5_000, " ".join(base)))
    rows += [(6_000 + i, " ".join(base)) for i in range(40)]
    assert _near(documents(rows).repartition(5)) == brute.near_duplicates(rows)


def test_real_documents_and_partitions(spark, documents, real):
    want = brute.near_duplicates(real)
    assert _near(documents(real).repartition(17)) == want


def test_ids_that_are_null_or_repeated(documents):
    text = " ".join(f"w{k}" for k in range(20))
    rows = [(None, text), (4, text), (4, text), (9, text), (None, None)]
    got = [(r.doc_id, r.component_id) for r in jaccard.near_duplicates(documents(rows)).collect()]
    assert sorted(got, key=str) == sorted([(None, None), (4, 4), (4, 4), (9, 4), (None, None)], key=str)
    assert jaccard.near_duplicates(documents([])).count() == 0


def test_two_sets_within_reach_share_a_block():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 4, 7, 8, 10, 63, 64, 85, 300, 511, 512, 680):
        for _ in range(10):
            a = rng.integers(1, 2**63, n).astype(np.uint64)
            # The furthest that a similarity of 3/4 allows, both ways of getting there.
            swapped = n // 7
            for b in (np.concatenate([a[swapped:], rng.integers(1, 2**63, swapped).astype(np.uint64)]),
                      np.concatenate([a, rng.integers(1, 2**63, n // 3).astype(np.uint64)])):
                text = np.repeat([0, 1], [len(a), len(b)])
                shingle = np.concatenate([np.sort(a), np.sort(b)])
                often = np.sort(rng.choice(a, n // 2)) if n > 1 else np.zeros(0, np.uint64)
                t, key = jaccard.sketch_blocks(text, shingle, often, 2)
                assert set(key[t == 0]) & set(key[t == 1]), n


def test_shingles():
    import pyarrow as pa

    texts = Texts.of(pa.array(["A b\tc d e F a b c d e f", "x Y", None, "", "É é"]))
    text, _ = jaccard.shingle_sets(texts)
    assert np.bincount(text, minlength=5).tolist() == [6, 1, 0, 0, 1]


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def _linked(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(df).collect()}


def _clusters(seed, dims, clusters, each, labels=3):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(clusters):
        base, label = rng.normal(size=dims), int(rng.integers(labels))
        for _ in range(int(rng.integers(1, each))):
            noisy = base + rng.normal(size=dims) * rng.choice([0, 0.05, 0.1, 0.15])
            rows.append((len(rows) * 3, [float(x) for x in noisy * rng.uniform(0.1, 9)], label))
    return rows


@pytest.mark.parametrize("dims", [2, 16])
def test_vectors_like_brute_force(spark, dims, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    rows = _clusters(dims, dims, 60, 9)
    got = _linked(_vectors(spark, rows).repartition(5))
    assert got == brute.near_vectors(rows)


def test_real_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding], r.label) for r in df.collect()]
    assert _linked(df) == brute.near_vectors(rows)


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None),
        (5, None, 1), (6, [0.0, 0.0], 1), (7, [1.0, None], 1), (8, [nan, 1.0], 1),
        (9, [1.0, 0.0, 0.0], 1), (10, [], 1), (11, [1.0, 0.1], 1), (12, [1.0, 0.0], 1),
        (13, [-0.0, 1.0], 1), (14, [0.0, 1.0], 1), (15, [inf, 0.0], 1), (16, [1e-200, 0.0], 1),
    ]
    got = _linked(_vectors(spark, rows))
    assert got.pop(16) == (4, 1)
    want = brute.near_vectors([r for r in rows if r[0] != 16])
    assert got == {i: (n + (c == 1 and n > 0), c) for i, (n, c) in want.items()}
    kept = {r.vec_id: r.kept for r in embeddings.near_vectors(_vectors(spark, rows)).collect()}
    assert sorted(i for i, k in kept.items() if not k) == [2, 11, 12, 14, 16]


def test_vectors_without_id_and_none(spark):
    rows = [(None, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1)]
    got = sorted(((r.vec_id, r.n_links) for r in embeddings.near_vectors(_vectors(spark, rows)).collect()), key=str)
    assert got == sorted([(None, 0), (2, 2), (3, 2), (3, 2)], key=str)
    assert embeddings.near_vectors(_vectors(spark, [])).count() == 0


def test_probes_and_codes_lose_nothing():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = x + rng.normal(size=x.shape) * 0.02
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    index = embeddings.ProductIndex.fit(x[:300])
    reach = np.linalg.norm(x - y, axis=1)
    own = index.lists(x)
    probes = index.probes(x, own, reach[:, None])
    lists = index.lists(y)
    assert probes[np.arange(600), lists].all() and probes.mean() < 0.9
    for at in np.unique(lists):
        row = np.flatnonzero(lists == at)
        codes, error = index.encode(y[row] - index.coarse[at])
        near = index.distances(x[row] - index.coarse[at], codes)
        assert (np.diag(near) <= reach[row] + error + 1e-9).all()


def test_every_link_is_counted(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "_MEMBERS", 8)
    rng = random.Random(11)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows += [(100 + k, rows[3 * k % 7][1].upper()) for k in range(6)]
    rows += [(200, "quite other words"), (201, "quite other words"), (202, ""), (203, None)]
    sets = {d: brute.shingle_set(t) for d, t in rows}
    want = {
        d: sum(
            d != e and len(s & t) > 0 and 100 * len(s & t) >= 75 * len(s | t)
            for e, t in sets.items()
        )
        for d, s in sets.items()
    }
    got = jaccard.linked_documents(documents(rows).repartition(4)).collect()
    assert {r.doc_id: r.n_links for r in got} == want
    groups = brute.near_duplicates(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == groups
    assert len(set(want.values())) > 5


def test_stars_need_no_round_and_little_rows_few_tasks(spark, monkeypatch):
    from fleetstream.llm import components as module

    names, store, cores = [], module.written, spark.sparkContext.defaultParallelism
    tasks = lambda df: df.rdd.getNumPartitions()
    monkeypatch.setattr(module, "written", lambda df, name: names.append((name, tasks(df))) or store(df, name))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", 5 * cores)
    try:
        stars = [(k, 0) for k in range(1, 30)] + [(200, 100)]
        found = components(spark.createDataFrame(stars, "a long, b long")).collect()
        assert [name for name, _ in names] == ["links"]
        assert {r.id: r.component for r in found} == {a: b for a, b in stars} | {0: 0, 100: 100}
        path = [(k, k + 1) for k in range(40)]
        found = components(spark.createDataFrame(path, "a long, b long").repartition(11)).collect()
        assert {(r.id, r.component) for r in found} == {(k, 0) for k in range(41)}
        assert max(n for name, n in names if name != "links") <= cores
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_components_of_near_duplicates_read_stored_links(documents, monkeypatch):
    plans, found = [], jaccard.components
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(jaccard, "components", lambda df: plans.append(plan(df)) or found(df))
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, text), (2, text + " more"), (3, "other words than these"), (4, text)]
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(documents(rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 1}
    assert plans and not any("InArrow" in p for p in plans)


def test_memory_is_given_back_after_a_group_too(monkeypatch):
    from fleetstream.llm import storage

    order = []
    monkeypatch.setattr(storage, "release_memory", lambda: order.append("released"))
    assert storage.releasing(lambda x, y: order.append("worked") or x + y, 1, 2) == 3
    assert order == ["released", "worked", "released"]


def test_scoring_frees_its_words_before_memory_is_given_back(spark, monkeypatch):
    import weakref

    import pandas as pd

    from fleetstream.llm import languages

    made, scorers, alive, udf = [], [], [], languages.F.pandas_udf
    monkeypatch.setattr(languages.F, "pandas_udf", lambda f, kind: made.append(f) or udf(f, kind))

    class Watched(languages.Scorer):
        def __init__(self, model):
            super().__init__(model)
            scorers.append(weakref.ref(self))

    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = languages.fit(docs)
    monkeypatch.setattr(languages, "Scorer", Watched)
    languages.predict(docs, model)
    monkeypatch.setattr(
        languages, "release_memory", lambda: alive.append([s() is not None for s in scorers])
    )
    assert len(list(made[0](iter([pd.Series(["a b", None])])))) == 1
    assert alive == [[], [False]]
