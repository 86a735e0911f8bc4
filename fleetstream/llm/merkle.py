"""Merkle trees over the rows of a table, with a proof for every row.

The rows of each group are the leaves of a tree, whose top is the group's subroot; the
subroots are the leaves of one more tree, whose top is the root. Eight consecutive nodes
become their hash, level by level.

Digests travel by time-forward processing. Every node has a label greater than those of its
children and sends its digest to its parent through a priority queue ordered by the
receiver's label. The queue is external: within a block of four levels it is a heap, and what
leaves a block waits in a stored table, from which a shuffle by label delivers it to the
block that needs it. The reversed sweep goes through the stored blocks from the root down
and hands every node the proof of its parent, to which the node adds its own siblings.

No step holds more than a block of 4,096 nodes; n leaves take log(n) / log(4,096) rounds.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetstream.llm.storage import shuffle_partitions, written

ARITY = 8
#: Levels that a block climbs, and the nodes at its foot.
_LEVELS = 4
_FOOT = ARITY**_LEVELS

_PROOF = "array<struct<before: string, after: string>>"
_MESSAGE = "tree string, pos bigint, digest string, above int"


def digest_of(columns: Sequence[Column]) -> Column:
    """Lowercase hex sha256 of the columns, each ``-`` if null, else its UTF-8 byte
    count, a colon and its value as text."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(
        F.concat(
            *[
                F.coalesce(
                    F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")
                )
                for t in texts
            ]
        ),
        256,
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its proof give."""
    return F.aggregate(
        proof, leaf, lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]), 256)
    )


def siblings(proof: Column) -> Column:
    """All digests of a proof, level by level and from left to right, as one text."""
    return F.array_join(
        F.transform(proof, lambda s: F.concat(s["before"], s["after"])), ""
    )


def _hash(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def block_levels(digests: list[str], levels: int) -> list[list[str]]:
    """The digests of a block's nodes, level by level from its foot, by a priority queue
    of (label of the receiver, place of the sender, digest)."""
    found: list[list[str]] = [digests] + [[] for _ in range(levels)]
    queue = [((1, k // ARITY), k, d) for k, d in enumerate(digests)] if levels else []
    while queue:
        label, children = queue[0][0], []
        while queue and queue[0][0] == label:
            children.append(heapq.heappop(queue)[2])
        level, place = label
        found[level].append(_hash(children))
        if level < levels:
            sent = ((level + 1, place // ARITY), place, found[level][-1])
            heapq.heappush(queue, sent)
    return found


def _ordered(nodes: pa.Table) -> tuple[pa.Table, int]:
    """The nodes of a block in order, and the levels it climbs."""
    nodes = nodes.take(np.argsort(nodes.column("pos").to_numpy()))
    return nodes, min(nodes.column("above")[0].as_py(), _LEVELS)


def _sent_up(nodes: pa.Table) -> pa.Table:
    """The message that the top of a block sends on."""
    nodes, levels = _ordered(nodes)
    (top,) = block_levels(nodes.column("digest").to_pylist(), levels)[-1]
    first = nodes.slice(0, 1)
    return pa.table(
        {
            "tree": first.column("tree").cast(pa.string()),
            "pos": [first.column("pos")[0].as_py() // _FOOT],
            "digest": [top],
            "above": pa.array([first.column("above")[0].as_py() - levels], pa.int32()),
        }
    )


def _handed_down(nodes: pa.Table, top: pa.Table) -> pa.Table:
    """The nodes at the foot of a block, each with its whole proof."""
    nodes, levels = _ordered(nodes)
    found = block_levels(nodes.column("digest").to_pylist(), levels)
    suffix = top.column("proof")[0].as_py()
    before, after, step = [], [], []
    for level, digests in enumerate(found[:levels]):
        step.append(len(before) + np.arange(nodes.num_rows) // ARITY**level)
        for k in range(len(digests)):
            first = k - k % ARITY
            before.append("".join(digests[first:k]))
            after.append("".join(digests[k + 1 : first + ARITY]))
    for s in suffix:
        step.append(np.full(nodes.num_rows, len(before)))
        before.append(s["before"])
        after.append(s["after"])
    at = np.stack(step, axis=1) if step else np.zeros((nodes.num_rows, 0), np.int64)
    steps = pa.StructArray.from_arrays(
        [pa.array(x, pa.string()).take(pa.array(at.ravel())) for x in (before, after)],
        names=["before", "after"],
    )
    proof = pa.ListArray.from_arrays(
        pa.array(np.arange(nodes.num_rows + 1) * at.shape[1], pa.int32()), steps
    )
    reached = top.column("reached")[0].as_py()
    return nodes.append_column("proof", proof).append_column(
        "reached", pa.array([reached] * nodes.num_rows, pa.string())
    )


def _levels_above(size: Column) -> Column:
    """The levels of a tree over so many leaves: the octal digits of the last place."""
    octal = F.conv((size - 1).cast("string"), 10, ARITY)
    return F.when(size > 1, F.length(octal)).otherwise(F.lit(0)).cast("int")


def _placed(leaves: DataFrame, by: list) -> DataFrame:
    """Leaves with ``pos``, their place in their tree, and ``above``, its levels.

    Leaves are ranked in a range partitioning and numbered within each part; the leaves
    of a tree in earlier parts come from a table of one row per tree and part.
    """
    row = F.monotonically_increasing_id()
    names = leaves.columns
    ranked = (
        leaves.select("*", *[c.alias(f"_by_{k}") for k, c in enumerate(by)], row.alias("_row"))
        .repartitionByRange(
            shuffle_partitions(leaves), "tree", *[f"_by_{k}" for k in range(len(by))], "_row"
        )
        .sortWithinPartitions("tree", *[f"_by_{k}" for k in range(len(by))], "_row")
        .select(*names, F.monotonically_increasing_id().alias("_at"))
    )
    stored = written(ranked, "leaves")
    part = F.shiftright("_at", 33)
    runs = stored.groupBy("tree", part.alias("_part")).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_n")
    )
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "tree",
        "_part",
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        _levels_above(F.sum("_n").over(tree)).alias("above"),
    )
    return (
        stored.withColumn("_part", part)
        .join(runs, ["tree", "_part"])
        .select(*names, (F.col("_at") + F.col("_shift")).alias("pos"), "above")
    )


class _Trees:
    """Trees that have been climbed: the stored nodes at the foot of every round."""

    def __init__(self, leaves: DataFrame):
        """``leaves`` has tree, pos, above, digest and any more columns."""
        self.feet = [written(leaves, "nodes")]
        most = self.feet[0].agg(F.max("above")).first()[0] or 0
        for _ in range(0, most, _LEVELS):
            foot = self.feet[-1].where("above > 0").select("tree", "pos", "digest", "above")
            up = foot.groupBy("tree", F.expr(f"pos div {_FOOT}")).applyInArrow(
                _sent_up, _MESSAGE
            )
            self.feet.append(written(up, "nodes"))

    def tops(self) -> DataFrame:
        """tree, digest of the node that remains."""
        ends = [f.where("above = 0").select("tree", "digest") for f in self.feet]
        out = ends[0]
        for end in ends[1:]:
            out = out.union(end)
        return out

    def leaves(self, tops: DataFrame) -> DataFrame:
        """Leaves with ``proof`` and ``reached``, which ``tops`` has by tree."""
        down = None
        for foot in reversed(self.feet):
            ends = foot.where("above = 0").join(
                tops.select("tree", "proof", "reached"), "tree"
            )
            ends = ends.select(*foot.columns, "proof", "reached")
            if down is None:
                down = ends
                continue
            schema = foot.schema.simpleString()[len("struct<") : -1]
            below = (
                foot.where("above > 0")
                .groupBy("tree", F.expr(f"pos div {_FOOT}").alias("_block"))
                .cogroup(down.groupBy("tree", F.col("pos").alias("_block")))
                .applyInArrow(_handed_down, f"{schema},proof:{_PROOF},reached:string")
            )
            down = ends.union(below)
        return down


#: What ``proven`` adds.
RESULT = ("subroot", "root", "proof")


def proven(
    rows: DataFrame, leaf: str = "leaf", group: str = "lang", by: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The rows with ``subroot``, ``root`` and ``proof``, the texts of sibling digests that
    stand before and after on every level from the leaf to the root.

    ``leaf`` holds digests as hex text; a row without one is an error. Rows of one
    ``group`` make a tree in ascending order of ``by`` (null first), then of their digest,
    so that equal rows may take each other's place. Groups are ordered as UTF-8 bytes,
    null first. A lone node is what remains of its tree, also where it is a leaf; a run of
    one node below becomes its own hash. An empty table has no root and gives no rows.
    Other columns stay, whatever their names; one named like a result is replaced.
    """
    kept = [c for c in rows.columns if c not in RESULT]
    name = F.col(f"`{group}`").cast("string")
    digest = F.col(f"`{leaf}`")
    leaves = rows.select(
        F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("tree"),
        F.coalesce(digest, F.raise_error(F.lit("a leaf without digest"))).alias("digest"),
        F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(kept)]).alias("row"),
    )
    keys = [F.col("row")[f"c{kept.index(c)}"] for c in by]
    trees = _Trees(_placed(written(leaves, "rows"), [*keys, F.col("digest")]))

    subroots = trees.tops().select(
        F.lit("").alias("tree"), "digest", F.col("tree").alias("group")
    )
    above = _Trees(_placed(written(subroots, "subroots"), [F.col("group")]))
    top = above.tops().first()
    root = F.lit(top["digest"] if top else None).cast("string")
    bare = above.tops().select(
        "tree", F.lit(None).cast("string").alias("reached"), F.array().cast(_PROOF).alias("proof")
    )
    tops = above.leaves(bare).select(
        F.col("group").alias("tree"), "proof", F.col("digest").alias("reached")
    )
    return trees.leaves(written(tops, "tops")).select(
        *[F.col("row")[f"c{k}"].alias(c) for k, c in enumerate(kept)],
        F.col("reached").alias("subroot"),
        root.alias("root"),
        "proof",
    )


#: The fields of a document that its leaf covers, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def tampered_text() -> Column:
    """``text`` with A-Z in lower case where three divides crc32(doc_id as text); a row
    without a doc_id is left alone."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return F.when(hit, F.translate("text", _UPPER, _UPPER.lower())).otherwise(F.col("text"))


def verified_documents(docs: DataFrame) -> DataFrame:
    """doc_id, lang, the leaf of every document, its proof, and whether the text as it
    would be after tampering still folds to the root.

    Texts are hashed where they are read and never shuffled, whatever their length; a null
    differs from an empty text. Columns other than those of the leaf are left out.
    """
    found = {c: F.col(c) for c in FIELDS}
    leaves = docs.select(
        "doc_id",
        "lang",
        digest_of(list(found.values())).alias("leaf"),
        digest_of(list((found | {"text": tampered_text()}).values())).alias("presented"),
    )
    rows = proven(leaves)
    fold = folded(F.col("presented"), F.col("proof"))
    return rows.withColumn("folded_root", fold).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )
