import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from fleetstream.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    texts = [None if x is None else str(x) for x in row]
    return h("-" if t is None else f"{len(t.encode())}:{t}" for t in texts)


def tampered(row):
    doc_id, source, lang, n_chars, text = row
    if doc_id is None or text is None or zlib.crc32(str(doc_id).encode()) % 3:
        return row
    return doc_id, source, lang, n_chars, "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def proofs(leaves):
    """Top, and for every leaf the (before, after) of each level."""
    found, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for k, place in enumerate(at):
            first = place // 8 * 8
            found[k].append(("".join(level[first:place]), "".join(level[place + 1 : first + 8])))
        level = [h(level[i : i + 8]) for i in range(0, len(level), 8)]
        at = [place // 8 for place in at]
    return level[0], found


def fold(digest, proof):
    for before, after in proof:
        digest = h([before, digest, after])
    return digest


def brute(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    tops = {}
    for lang in order:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        tops[lang] = proofs([leaf_of(r) for r in trees[lang]])
    if not order:
        return []
    root, above = proofs([tops[lang][0] for lang in order])
    out = []
    for lang, high in zip(order, above):
        subroot, low = tops[lang]
        for row, proof in zip(trees[lang], low):
            proof = proof + high
            got = fold(leaf_of(tampered(row)), proof)
            out.append(
                (row[0], leaf_of(row), subroot, root, h(b + a for b, a in proof), got, got == root)
            )
    return sorted(out, key=repr)


def found(df):
    rows = merkle.verified_documents(df).select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(merkle.siblings(F.col("proof")), 256), "folded_root", "verified",
    )
    return sorted(map(tuple, rows.collect()), key=repr)


def documents(n, seed, langs=("en", "de", None, "", "é")):
    rng = random.Random(seed)
    words = ["Ab", "cd", "É", "漢字", "x|y", ""]
    return [
        (i, rng.choice(["s0", None]), rng.choice(langs), rng.choice([i, None]),
         rng.choice([None, " ".join(rng.choices(words, k=5))]))
        for i in range(n)
    ]


@pytest.mark.parametrize("n", [1, 2, 8, 9, 65, 300])
def test_like_brute_force(spark, n):
    rows = documents(n, n)
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_one_tree_over_many_blocks(spark):
    """One group with nearly all rows needs two rounds; another is a lone leaf."""
    rows = documents(4096 * 2 + 70, 3, ["en"]) + [(-5, "s", "zz", 1, "Lone Leaf")]
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(7)) == brute(rows)


def test_many_groups(spark):
    rows = documents(200, 4, [f"l{k}" for k in range(90)])
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_nulls_ties_and_long_texts(spark):
    rows = [
        (None, None, None, None, None), (None, "a", None, 1, ""), (3, "A", "en", 2, "AbC" * 400_000),
        (3, "A", "en", 2, "AbC"), (3, "A", "en", 2, "AbC"), (3, "A", "en", 2, "abc"),
        (0, "", "", 0, ""), (-1, "-", "-", 0, "-"),
    ]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_hot_row(spark):
    """A third of all rows are the same; their order among each other does not matter."""
    rows = documents(600, 6) + [(7, "s", "en", 3, "The same")] * 300
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_clashing_columns(spark):
    rows = documents(40, 8)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("tree", "pos", "row", "digest", "above", "proof", "leaf", "root", "_at", "_row", "presented"):
        df = df.withColumn(name, F.lit("other"))
    assert found(df) == brute(rows)
    leaves = df.drop("leaf", "proof").withColumn("leaf", merkle.digest_of([F.col("doc_id")]))
    out = merkle.proven(leaves)
    assert out.columns == [c for c in leaves.columns if c != "root"] + list(merkle.RESULT)
    (row,) = out.where("doc_id = 11").collect()
    assert (row["tree"], row["_at"], row["digest"]) == ("other",) * 3 and len(row["root"]) == 64


def test_partitions_do_not_matter(spark):
    rows = documents(500, 9)
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df.repartition(1)) == found(df.repartition(13))


def test_every_change_shows(spark):
    rows = documents(30, 10)
    df = spark.createDataFrame(rows, SCHEMA)
    leaves = df.withColumn("leaf", merkle.digest_of([F.col(c) for c in merkle.FIELDS]))
    for column, other in (("source", "s1"), ("lang", "xx"), ("n_chars", -3), ("text", "other")):
        changed = [F.lit(other) if c == column else F.col(c) for c in merkle.FIELDS]
        folds = merkle.proven(leaves).withColumn("changed", merkle.digest_of(changed))
        folds = folds.withColumn("f", merkle.folded(F.col("changed"), F.col("proof")))
        assert folds.where("f = root").count() == 0
    with pytest.raises(Exception, match="without digest"):
        merkle.proven(leaves.withColumn("leaf", F.lit(None).cast("string"))).collect()


def test_queue_delivers_in_order():
    digests = [h([str(k)]) for k in range(100)]
    levels = merkle.block_levels(digests, 3)
    assert [len(x) for x in levels] == [100, 13, 2, 1]
    assert levels[1] == [h(digests[i : i + 8]) for i in range(0, 100, 8)]
    assert merkle.block_levels(["a"], 0) == [["a"]]
