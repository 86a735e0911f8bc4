"""Suffix-array dedup by bucket-pointer refinement, on bytes.

Suffixes begin in buckets of equal q-grams. A bucket with one suffix is finished. The
others are refined by the bucket identifiers that their suffixes have at later offsets:
q-grams and those q bytes on give buckets of 2 q bytes, whose identifiers, used again,
give 4 q, up to the wanted length. An identifier is a hash of what it stands for, so a
later offset's identifier is known where the text is and no table of ranks is moved. Of
the suffixes with one least q-gram in reach, only the first and last are followed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fleetstream.llm.repeats import Windows, repeated_units
from fleetstream.llm.windows import Texts, Units, single_bytes

MATCH_BYTES = 200
QGRAM_BYTES = 64
_SCHEMA = (
    "n_bytes bigint, n_removed bigint, n_spans bigint, "
    "kept_sha256 string, kept binary"
)


def _rows(texts: Texts, units: Units, repeated: np.ndarray) -> pa.Table:
    offsets, data = texts.offsets, texts.data
    removed = np.zeros(len(data), dtype=bool)
    removed[: len(repeated)] = repeated
    begins = removed.copy()
    begins[1:] &= ~removed[:-1]
    firsts = offsets[:-1][np.diff(offsets) > 0]
    begins[firsts] = removed[firsts]
    total = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
    kept = [data[a:b][~removed[a:b]].tobytes() for a, b in zip(offsets, offsets[1:])]
    return pa.Table.from_arrays(
        [
            pa.array(np.diff(offsets)),
            pa.array(total(removed)),
            pa.array(total(begins)),
            pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
            pa.array(kept, pa.binary()),
        ],
        names=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
    )


def without_repeats(
    docs: DataFrame, length: int = MATCH_BYTES, q: int = QGRAM_BYTES
) -> DataFrame:
    """docs with n_bytes, n_removed, n_spans, kept_sha256 and kept.

    Removes each byte (UTF-8) in a string of ``length`` bytes that also begins anywhere
    else, in the same text too; strings are judged on the input and don't cross texts.
    Null and empty texts have no bytes; a repeated row is another place. ``kept`` can cut
    a character, so it is binary. No rows give no rows.
    """
    what = Windows(single_bytes, first=q, length=length, earlier=False)
    return repeated_units(docs, what, _rows, _SCHEMA)
