"""SimHash fingerprints of 128 bits, with DataFrame functions only.

A text's terms are its shingles of five consecutive words (all words as one where there
are fewer). Every occurrence of a term votes on each bit with the sign of that bit of the
term's hash, so a term weighs as much as it is frequent; the fingerprint has the bits with
more votes for than against. Votes are counted two to a long: the low half counts bit i,
the high half bit i + 32.

``near_pairs`` finds all fingerprints within a Hamming radius r through r + 1 tables: cut
into r + 1 blocks, two such fingerprints agree on a block, and table t is permuted so that
block t is its key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BITS = 128
SHINGLE_WORDS = 5
#: Rows of one range of doc_ids, and ranges at most; their bounds are literals.
_RANGE_ROWS = 256
_MOST_RANGES = 10_000
_FIRST_ID = -(2**63)

_WORD_SEPARATOR = r"[\x20\x09-\x0D]+"
_TWO = 0x0000_0001_0000_0001
_LOW = 0xFFFF_FFFF


def _term_hashes(text: Column, words: int = SHINGLE_WORDS) -> tuple[Column, Column, Column]:
    """Word hashes of a text; the number of its terms; hash of the term at ``_at``."""
    found = F.filter(F.split(text, _WORD_SEPARATOR), lambda w: w != "")
    hashes = F.transform(found, lambda w: F.xxhash64(w))
    size = F.size("_words")
    terms = F.when(size == 0, 0).otherwise(F.greatest(size - (words - 1), F.lit(1)))
    # Beyond the end of a short text the words are null, which hashes as nothing.
    term = F.xxhash64(*[F.get("_words", F.col("_at") + k) for k in range(words)])
    return hashes, terms, term


def _votes(first: Column, second: Column) -> list[Column]:
    two = F.lit(_TWO)
    return [
        F.sum(F.shiftrightunsigned(h, i).bitwiseAND(two)).alias(f"_{half}{i}")
        for half, h in (("a", first), ("b", second))
        for i in range(32)
    ]


def _half(half: str) -> Column:
    """64 bits from the votes: one where more than half of all terms have a one."""
    votes = ", ".join(f"_{half}{i}" for i in range(32))
    # Over an array, as one expression per bit is too much code for one stage.
    return F.expr(f"""aggregate(transform(array({votes}), (v, i) ->
        shiftleft(if(2 * (v & {_LOW}L) > _n, 1L, 0L), i)
        | shiftleft(if(2 * shiftrightunsigned(v, 32) > _n, 1L, 0L), i + 32)),
        0L, (bits, x) -> bits | x)""")


def fingerprinted(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, fp_hi, fp_lo: the fingerprint of ``text`` for every different key.

    A null text or one without words has the fingerprint 0. ``keys`` tell rows apart;
    where the rows already lie by some of them, nothing is shuffled.
    """
    hashes, terms, term = _term_hashes(F.coalesce(F.col(text), F.lit("")))
    words = df.select(*keys, hashes.alias("_words"))
    last = F.when(terms > 0, terms - 1)
    exploded = words.select(
        *keys, "_words", F.explode_outer(F.sequence(F.lit(0), last)).alias("_at")
    )
    known, none = F.col("_at").isNotNull(), F.lit(0).cast("long")
    hashed = exploded.select(
        *keys, "_at", F.when(known, term).otherwise(none).alias("_h")
    ).select(*keys, "_at", "_h", F.when(known, F.xxhash64("_h", F.lit(1))).otherwise(none).alias("_g"))
    votes = hashed.groupBy(*keys).agg(
        F.count("_at").alias("_n"), *_votes(F.col("_h"), F.col("_g"))
    )
    return votes.select(*keys, _half("a").alias("fp_hi"), _half("b").alias("fp_lo"))


def likeness(hi: Column, lo: Column, other_hi: Column, other_lo: Column) -> Column:
    """Share of equal bits."""
    return 1 - _distance(hi, lo, other_hi, other_lo) / F.lit(float(BITS))


def _distance(hi, lo, other_hi, other_lo) -> Column:
    return F.bit_count(hi.bitwiseXOR(other_hi)) + F.bit_count(lo.bitwiseXOR(other_lo))


def hexadecimal(hi: Column, lo: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def _literals(values: list, kind: str) -> Column:
    return F.lit(values).cast(f"array<{kind}>")


def _ranges(docs: DataFrame) -> tuple[Column, list[int], int]:
    """The range of ``_ord`` as a column, and how many there are.

    Bounds are quantiles of the ids, looked up in two steps: among every s-th bound, then
    among the s bounds from there.
    """
    ids = docs.select("_ord")
    count = ids.count()
    wanted = min(_MOST_RANGES, -(-count // _RANGE_ROWS))
    if wanted <= 1:
        return F.lit(0), 1
    # Cast to double only rounds the bounds; the comparison below is on whole numbers.
    found = ids.approxQuantile("_ord", [k / wanted for k in range(1, wanted)], 0.2 / wanted)
    bounds = sorted({int(x) for x in found})
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[k : k + step] for k in range(0, len(bounds), step)]
    below = lambda array: F.size(F.filter(array, lambda b: b <= F.col("_ord")))
    group = F.greatest(below(_literals([g[0] for g in groups], "bigint")) - 1, F.lit(0))
    fine = F.get(_literals(groups, "array<bigint>"), group)
    return group * step + below(fine), len(bounds) + 1


def with_next(docs: DataFrame) -> DataFrame:
    """Every row with the text of the next row in descending doc_id, first after last.

    Adds _range, _nr, _copy and _next_text. Rows are dealt by ranges of doc_id; the first
    row of a range is copied to the end of the range before it (``_copy``), so that each
    text moves once. Equal doc_ids are ordered by text; rows without a doc_id come last.
    """
    ordered = docs.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("doc_id", F.lit(_FIRST_ID)).alias("_ord"),
    )
    where, size = _ranges(ordered)
    placed = ordered.withColumn("_range", where)
    tops = {r["_range"]: r["top"] for r in placed.groupBy("_range").agg(
        F.max("_ord").alias("top")).collect()}
    if not tops:
        return ordered.selectExpr(
            "*", "0 AS _range", "0 AS _nr", "false AS _copy", "text AS _next_text"
        )
    present = sorted(tops, reverse=True)
    # The range that comes before this one when ids fall; the last before the first.
    before = dict(zip(present, [present[-1], *present[:-1]]))
    is_top = F.col("_ord") == F.get(
        _literals([tops.get(k) for k in range(size)], "bigint"), F.col("_range")
    )
    copied_to = F.get(_literals([before.get(k) for k in range(size)], "int"), F.col("_range"))
    own = F.struct(F.col("_range").alias("r"), F.lit(False).alias("c"))
    copy = F.struct(copied_to.alias("r"), F.lit(True).alias("c"))
    dealt = placed.select(
        "doc_id",
        "text",
        "_ord",
        F.explode(F.when(is_top, F.array(own, copy)).otherwise(F.array(own))).alias("_to"),
    ).select("doc_id", "text", "_ord", F.col("_to.r").alias("_range"), F.col("_to.c").alias("_copy"))
    order = Window.partitionBy("_range").orderBy("_copy", F.desc("_ord"), "text")
    return dealt.select(
        "*",
        F.row_number().over(order).alias("_nr"),
        F.lead("text").over(order).alias("_next_text"),
    )


def edited_and_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited versions, and their likeness.

    The edited text has its last floor(n/2) code points replaced by the first as many (or
    all) of the next text in descending doc_id. Returns doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next. A null text counts as empty;
    an only row is its own next row; no rows give no rows.
    """
    rows = with_next(docs)
    size = F.char_length("text")
    half = F.floor(size / 2)
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), size - half),
        F.substring(F.coalesce("_next_text", F.lit("")), F.lit(1), half),
    )
    keys = ["_range", "_nr", "_copy", "doc_id", "n_chars", "edited_sha256"]
    versions = rows.select(
        "_range", "_nr", "_copy", "doc_id",
        size.cast("long").alias("n_chars"), "text", edited.alias("_edited"),
    ).select(
        "*", F.sha2("_edited", 256).alias("edited_sha256")
    ).select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("v"), F.col("text").alias("t")),
                F.struct(F.lit(1).alias("v"), F.col("_edited").alias("t")),
            )
        ).alias("_v"),
    ).select(*keys, F.col("_v.v").alias("_version"), F.col("_v.t").alias("_text"))
    prints = fingerprinted(versions, [*keys, "_version"], "_text")
    # Both versions of a row and all rows of a range lie together already.
    of = lambda v, c: F.max(F.when(F.col("_version") == v, F.col(c))).alias(f"{c}{v}")
    both = prints.groupBy(*keys).agg(
        of(0, "fp_hi"), of(0, "fp_lo"), of(1, "fp_hi"), of(1, "fp_lo")
    )
    order = Window.partitionBy("_range").orderBy("_nr")
    hi, lo = F.col("fp_hi0"), F.col("fp_lo0")
    nexts = both.select(
        "*", F.lead("fp_hi0").over(order).alias("_hi"), F.lead("fp_lo0").over(order).alias("_lo")
    )
    return nexts.where(~F.col("_copy")).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hexadecimal(hi, lo).alias("fingerprint"),
        hexadecimal(F.col("fp_hi1"), F.col("fp_lo1")).alias("edited_fingerprint"),
        likeness(hi, lo, F.col("fp_hi1"), F.col("fp_lo1")).alias("near_edited"),
        likeness(hi, lo, F.col("_hi"), F.col("_lo")).alias("near_next"),
    )


def near_pairs(prints: DataFrame, radius: int = 3) -> DataFrame:
    """(hi_a, lo_a, hi_b, lo_b, distance) of different fingerprints within the radius.

    ``prints`` has fp_hi and fp_lo; equal ones count once, so copies don't multiply. A
    pair comes from the first table on which it meets, which needs no distinct.
    """
    blocks = radius + 1
    if not 1 <= blocks <= BITS // 8:
        raise ValueError(f"the radius must be from 0 to {BITS // 8 - 1}")
    cuts = [round(k * BITS / blocks) for k in range(blocks + 1)]
    digits = F.concat(
        *[F.lpad(F.bin(c), 64, "0") for c in (F.col("fp_hi"), F.col("fp_lo"))]
    )
    keys = [F.substring(digits, a + 1, b - a) for a, b in zip(cuts, cuts[1:])]
    tables = (
        prints.select("fp_hi", "fp_lo")
        .where(F.col("fp_hi").isNotNull() & F.col("fp_lo").isNotNull())
        .distinct()
        .select("fp_hi", "fp_lo", F.array(*keys).alias("_keys"))
        .select("*", F.posexplode("_keys").alias("_table", "_key"))
    )
    a, b = tables.alias("a"), tables.alias("b")
    met = a.join(
        b,
        (F.col("a._table") == F.col("b._table"))
        & (F.col("a._key") == F.col("b._key"))
        & (F.struct("a.fp_hi", "a.fp_lo") < F.struct("b.fp_hi", "b.fp_lo")),
    )
    distance = _distance(*[F.col(c) for c in ("a.fp_hi", "a.fp_lo", "b.fp_hi", "b.fp_lo")])
    agree = F.zip_with("a._keys", "b._keys", lambda x, y: x == y)
    first = F.array_position(agree, True) - 1 == F.col("a._table")
    return met.where(first & (distance <= radius)).select(
        F.col("a.fp_hi").alias("hi_a"), F.col("a.fp_lo").alias("lo_a"),
        F.col("b.fp_hi").alias("hi_b"), F.col("b.fp_lo").alias("lo_b"),
        distance.alias("distance"),
    )
