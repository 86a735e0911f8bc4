import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from fleetstream.llm import languages, mixing
from fleetstream.llm.storage import written
from tests.llm.conftest import SF


def test_held_out_rows(spark):
    rows = [(i,) for i in range(-5, 60)] + [(None,)]
    df = spark.createDataFrame(rows, "doc_id long")
    got = {r.doc_id: r.h for r in df.select("doc_id", languages.held_out(F.col("doc_id")).alias("h")).collect()}
    assert got.pop(None) is False
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in got}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    rows = languages.identified(docs).where(languages.held_out(F.col("doc_id"))).collect()
    assert len(rows) > 200
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.99 * len(rows)
    assert all(0 <= r.lang_score <= 1 for r in rows)


def test_words_then_shorter_grams():
    model = languages.build_model({"a": {"hello": 3, "sun": 1}, "b": {"hallo": 3, "tag": 2}})
    scorer = languages.Scorer(model)
    assert (scorer.scores("hello")[0] == model.word_rows[model.words["hello"]]).all()
    gram = lambda *names: model.gram_rows[[model.grams[g] for g in names]].mean(axis=0)
    # Of the longest n-grams those that are known: "ellp" and "llp>" are not.
    assert np.allclose(model.of_unseen("hellp"), gram("<hel", "hell"))
    assert np.allclose(model.of_unseen("漢"), gram("<", ">"))
    plain = languages.Scorer(languages.build_model({"a": {"x": 1}, "b": {"y": 1}}, backoff=False))
    assert (plain.scores("unseen words")[0] == 0).all()
    assert scorer.scores("Sun, sun; zzz")[1] == 3


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(languages, "_REMEMBERED", 50)
    model = languages.build_model({"a": {"ab": 5}, "b": {"cd": 5}})
    scorer, rng = languages.Scorer(model), random.Random(1)
    texts = [" ".join("".join(rng.choice("abcd") for _ in range(4)) for _ in range(30)) for _ in range(40)]
    texts.append(" ".join(texts))
    for t in texts:
        want = np.sum([model.of_unseen(w) for w in t.split()], axis=0)
        assert np.allclose(scorer.scores(t)[0], want)


def test_undetermined_and_other_columns(spark):
    rows = [(1, "the cat", "en"), (2, "der hund", "de"), (3, None, "en"), (4, "", None),
            (5, "12 ½ !?", None), (6, "the", None), (6, "the", None)]
    docs = spark.createDataFrame(rows, "lang_x int, text string, lang string").withColumn("_found", F.lit(1))
    model = languages.fit(docs)
    got = languages.predict(docs, model)
    assert got.columns == ["lang_x", "text", "lang", "_found", "lang_pred", "lang_score"]
    found = sorted((r.lang_x, r.lang_pred) for r in got.collect())
    assert found == [(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "en"), (6, "en")]
    untrained = languages.fit(docs.limit(0))
    assert {r.lang_pred for r in languages.predict(docs, untrained).collect()} == {"und"}
    assert languages.predict(docs.limit(0), model).count() == 0


def _solve(tokens, p, goal, steps=20_000):
    """Projected gradient on the rates themselves."""
    w = np.ones(len(tokens))
    share = tokens / tokens.sum()
    size = 1 / np.linalg.eigvalsh((p * share[:, None]).T @ p).max()
    for _ in range(steps):
        w = np.maximum(0, w - size * p @ ((p * (share * w)[:, None]).sum(0) - goal))
    return w


def test_rates_like_brute_force(spark):
    rng = np.random.default_rng(5)
    p = rng.dirichlet([0.3, 0.3, 0.3], 80)
    tokens = rng.integers(0, 500, 80)
    df = spark.createDataFrame(
        [(i, int(t), [float(x) for x in q]) for i, (t, q) in enumerate(zip(tokens, p))],
        "doc_id long, _tokens long, _p array<double>",
    )
    for goal in ([0.5, 0.3, 0.2], [0.8, 0.15, 0.05]):
        rate, reached = mixing.fit_rates(written(df, "m"), goal, tolerance=1e-6)
        w = np.array([r.w for r in df.orderBy("doc_id").select(rate.alias("w")).collect()])
        want = _solve(tokens, p, np.array(goal))
        total = lambda x: (p * (x * tokens / tokens.sum())[:, None]).sum(0)
        assert (w >= 0).all() and np.abs(total(w) - reached).max() < 1e-9
        miss = np.abs(total(want) - goal).max()
        assert np.abs(total(w) - goal).max() <= miss + 2e-3


def test_mixed_documents_meet_their_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    targets = {"quality1_toxic0": 0.7, "quality0_toxic0": 0.2, "quality1_toxic1": 0.1}
    got = mixing.mixed_documents(docs, labels, targets).toPandas()
    assert len(got) == docs.count()
    p, tokens = np.array(got.posteriors.tolist()), got.n_tokens.to_numpy(float)
    shares = p * (tokens * got.rate.to_numpy())[:, None]
    shares = np.sort(shares.sum(0) / tokens.sum())[::-1]
    assert np.abs(shares[:3] - [0.7, 0.2, 0.1]).max() < 0.02
    off = got["copies"] - got.rate
    assert (off.abs() < 1).all() and abs(off.mean()) < 0.1


def test_mixing_edge_cases(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(1, "a b", 7), (2, None, 8), (2, "", 9), (None, "c " * 9, 1)], "doc_id long, text string, rate_ int")
    got = mixing.mixed_documents(docs, labels, {"quality1_toxic0": 1.0})
    assert got.columns[:3] == ["doc_id", "text", "rate_"]
    assert {r.rate for r in got.collect()} == {1.0} and got.count() == 4
    none = mixing.mixed_documents(docs.limit(0), labels.limit(0), {"x": 1.0})
    assert none.count() == 0
    unlabelled = mixing.mixed_documents(docs, labels.limit(0), {"x": 1.0}).collect()
    assert [r.copies for r in unlabelled] == [1] * 4


def test_every_word_of_the_sample_is_kept(spark):
    # Each word once in 'big'; the one word of 'small' is a word of both.
    texts = [(" ".join(_letters(i * 500 + k) for k in range(500)), "big") for i in range(60)]
    texts.append((_letters(29_999), "small"))
    model = languages.fit(spark.createDataFrame(texts, "text string, lang string"))
    assert len(model.words) == 30_000 and model.word_rows.dtype == np.float32
    row = model.word_rows[model.words[_letters(29_999)]]
    want = [np.log(1.5) - np.log(n + 0.5 * 30_001) for n in (30_000, 1)]
    assert np.allclose(row, want)
    assert model.longest == 5 and len(model.grams) > 0


def _letters(n):
    return "w" + "".join("abcdefghij"[int(x)] for x in f"{n:05d}")


def test_domains_back_off_to_grams(spark):
    docs = spark.createDataFrame([(1, "gambling casino"), (2, "library garden")], "doc_id long, text string")
    domains = spark.createDataFrame([(1, "x"), (2, "y")], "doc_id long, domain string")
    model = mixing.fit_domains(docs, domains)
    scores = languages.Scorer(model).scores("gamblings")[0]
    assert scores[0] > scores[1]


def test_returned_rates_meet_small_targets(spark):
    rng = np.random.default_rng(7)
    p = rng.dirichlet([6, 1, 0.3, 0.1], 3_000)
    tokens = rng.integers(1, 400, 3_000)
    df = spark.createDataFrame(
        [(int(t), [float(x) for x in q]) for t, q in zip(tokens, p)], "_tokens long, _p array<double>"
    )
    members = written(df, "m")
    goal = [0.4, 0.15, 0.44, 0.01]
    rate, reached = mixing.fit_rates(members, goal)
    rows = members.select("_tokens", "_p", rate.alias("w")).collect()
    w, t, q = (np.array(c, dtype=float) for c in zip(*[(r.w, r["_tokens"], r["_p"]) for r in rows]))
    got = (t * w) @ q / t.sum()
    assert (w >= 0).all() and np.abs(got - goal).max() <= 1e-4
    assert np.abs(got - reached).max() < 1e-9


def test_targets_out_of_reach_are_logged(spark, caplog):
    df = spark.createDataFrame([(10, [0.5, 0.5]), (30, [0.6, 0.4])], "_tokens long, _p array<double>")
    rate, reached = mixing.fit_rates(written(df, "m"), [0.9, 0.1])
    assert "out of reach" in caplog.text and min(reached) >= 0
    # The best is all of the second text: 0.6 x and 0.4 x nearest to the targets.
    x = (0.6 * 0.9 + 0.4 * 0.1) / (0.6**2 + 0.4**2)
    assert np.allclose(reached, [0.6 * x, 0.4 * x], atol=1e-4)


CLASHING = ("_found", "found", "_tokens", "_p", "lang_pred", "lang_score", "row", "rate", "copies")


def test_clashing_columns_keep_their_values(spark):
    rows = [(1, "the cat sat", "en"), (2, "der hund lief", "de"), (3, "", "en"), (4, None, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    extra = docs.selectExpr("*", *[f"concat('{c}', doc_id) AS `{c}`" for c in CLASHING])
    told = languages.predict(extra, languages.fit(docs))
    kept = [c for c in CLASHING if not c.startswith("lang_")]
    for r in told.collect():
        assert [r[c] for c in kept] == [f"{c}{r.doc_id}" for c in kept]
        assert r.lang_pred in ("en", "de", "und") and 0 <= r.lang_score <= 1
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    mixed = mixing.mixed_documents(extra, labels, {"quality1_toxic0": 0.5, "quality0_toxic0": 0.5})
    kept = [c for c in CLASHING if c not in ("rate", "copies")]
    plain = {r.doc_id: r for r in mixing.mixed_documents(docs, labels, {"quality1_toxic0": 0.5, "quality0_toxic0": 0.5}).collect()}
    for r in mixed.collect():
        assert [r[c] for c in kept] == [f"{c}{r.doc_id}" for c in kept]
        assert (r.rate, r.copies, r.posteriors) == (plain[r.doc_id].rate, plain[r.doc_id].copies, plain[r.doc_id].posteriors)


def test_samples_of_huge_tables(spark):
    """The share of a sample does not fall to zero or step in millionths."""
    from fleetstream.llm.storage import chance

    many = spark.range(2_000_000).select(chance("id").alias("c"))
    for share in (1e-3, 1e-5):
        n = many.where(F.col("c") < share).count()
        assert abs(n - share * 2_000_000) < 6 * (share * 2_000_000) ** 0.5
    assert many.where("c < 0 OR c >= 1").count() == 0
    assert many.agg(F.min("c")).first()[0] < 1e-5 < 2**-10
