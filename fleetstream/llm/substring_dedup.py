"""Substring dedup by level-wise doubling, on words.

Windows of half the wanted length that are repeated are alone extended to twice that
length, and so on, until no candidates survive or the wanted length is reached: 7 words,
then 13. At the first level a window is stood for by the least hash among its shorter
windows, which leaves about a quarter of them to be counted.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fleetstream.llm.repeats import Windows, repeated_units
from fleetstream.llm.windows import Texts, Units, words

WINDOW_WORDS = 13
_SCHEMA = "n_words bigint, n_removed bigint, kept_sha256 string, kept_text string"


def _kept_bytes(texts: Texts, units: Units, kept: np.ndarray) -> list[bytes]:
    """Per text its kept words with one blank between them."""
    n = len(texts.data)
    # A word is taken with the byte behind it, which is white space inside a text.
    behind = np.minimum(units.end + 1, texts.offsets[units.text + 1])
    edge = np.bincount(units.start[kept], minlength=n + 1)
    edge -= np.bincount(behind[kept], minlength=n + 1)
    taken = np.cumsum(edge[:n]) > 0
    for_words = np.bincount(units.start, minlength=n + 1) - np.bincount(
        units.end, minlength=n + 1
    )
    blank = np.cumsum(for_words[:n]) == 0
    out = np.where(blank, np.uint8(0x20), texts.data)
    found = []
    for a, b in zip(texts.offsets, texts.offsets[1:]):
        found.append(out[a:b][taken[a:b]].tobytes().rstrip(b" "))
    return found


def _rows(texts: Texts, units: Units, repeated: np.ndarray) -> pa.Table:
    size = len(texts)
    kept = _kept_bytes(texts, units, ~repeated)
    return pa.Table.from_arrays(
        [
            pa.array(np.bincount(units.text, minlength=size)),
            pa.array(np.bincount(units.text[repeated], minlength=size)),
            pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
            pa.array([x.decode("utf-8", "replace") for x in kept]),
        ],
        names=["n_words", "n_removed", "kept_sha256", "kept_text"],
    )


def without_repeats(docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """docs with n_words, n_removed, kept_sha256 and kept_text.

    Removes each word in a window of ``window`` words that also begins in a text with a
    smaller doc_id; windows are judged on the input. Words are ``[^\\x20\\x09-\\x0D]+``.
    Null and empty texts have no words. Rows with one doc_id do not remove each other's
    words; a null doc_id counts as the largest. No rows give no rows.
    """
    what = Windows(words, first=window // 2 + 1, length=window, earlier=True)
    return repeated_units(docs, what, _rows, _SCHEMA)
