"""Units of texts, and hashes of windows of them, in numpy.

A unit is a word or a byte. A window's hash is built from those of shorter windows, each
length from two of at most half of it; hashes of longer pieces come from prefix sums of a
polynomial modulo 2**64. All arithmetic wraps.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of texts, or units of a longer text, that are worked on together.
PIECE_UNITS = 1 << 18

_BASE = 0x9E37_79B9_7F4A_7C15 | 5
_MODULUS = 1 << 64
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_HASH = np.random.RandomState(20_241).randint(0, 2**63, 256, dtype=np.int64).view(
    np.uint64
) | np.uint64(1)

_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of them."""
    if len(_powers[0]) < n:
        size = max(n, PIECE_UNITS + 4096)
        for k, base in enumerate((_BASE, pow(_BASE, -1, _MODULUS))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58_476D_1CE4_E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D0_49BB_1331_11EB)
    return h ^ (h >> np.uint64(31))


class Sums:
    """Prefix sums from which the hash of any stretch of units follows."""

    def __init__(self, units: np.ndarray):
        power, self._inverse = _up_to(len(units) + 1)
        self._sum = np.zeros(len(units) + 1, dtype=np.uint64)
        np.cumsum(units * power[: len(units)], dtype=np.uint64, out=self._sum[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (end - start).astype(np.uint64)
        raw = (self._sum[end] - self._sum[start]) * self._inverse[start]
        return mixed(raw + length * np.uint64(0xD6E8_FEB8_6659_FD93))


@dataclass
class Texts:
    """The bytes of consecutive texts and where each begins; null texts are empty."""

    data: np.ndarray
    offsets: np.ndarray

    @classmethod
    def of(cls, column: pa.ChunkedArray | pa.Array) -> Texts:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
        column = column.cast(pa.large_binary()).fill_null(b"")
        _, at, data = column.buffers()
        offsets = np.frombuffer(at, dtype=np.int64)[
            column.offset : column.offset + len(column) + 1
        ]
        raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
        return cls(raw[offsets[0] : offsets[-1]], offsets - offsets[0])

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def slices(self, most: int = PIECE_UNITS):
        """(first text, Texts) of about ``most`` bytes; a longer text is one of its own."""
        first = 0
        while first < len(self):
            last = int(np.searchsorted(self.offsets, self.offsets[first] + most, "right")) - 1
            last = min(max(last, first + 1), len(self))
            a, b = self.offsets[first], self.offsets[last]
            yield first, Texts(self.data[a:b], self.offsets[first : last + 1] - a)
            first = last


@dataclass
class Units:
    """Hash and text of every unit, and the bytes [start, end) that it has if it's a word."""

    hashes: np.ndarray
    text: np.ndarray
    start: np.ndarray | None = None
    end: np.ndarray | None = None


def words(texts: Texts) -> Units:
    """Words between white space of ASCII, unchanged."""
    data, n = texts.data, len(texts.data)
    solid = ~_WHITE[data]
    begins = np.zeros(n + 1, dtype=bool)
    begins[texts.offsets] = True
    after = np.ones(n, dtype=bool)
    after[1:] = ~solid[:-1]
    start = np.flatnonzero(solid & (after | begins[:n]))
    before = np.ones(n, dtype=bool)
    before[:-1] = ~solid[1:]
    end = np.flatnonzero(solid & (before | begins[1:])) + 1
    text = np.searchsorted(texts.offsets, start, "right") - 1
    return Units(Sums(_BYTE_HASH[data]).of(start, end), text, start, end)


def lower_ascii(texts: Texts) -> Texts:
    upper = (texts.data >= 65) & (texts.data <= 90)
    return Texts(texts.data + (upper * np.uint8(32)), texts.offsets)


def single_bytes(texts: Texts) -> Units:
    sizes = np.diff(texts.offsets)
    return Units(_BYTE_HASH[texts.data], np.repeat(np.arange(len(texts)), sizes))


def doubled(short: np.ndarray, length: int, wanted: int) -> np.ndarray:
    """Hashes of windows of ``wanted`` units from those of ``length`` (at least half)."""
    shift = wanted - length
    left, right = short[: len(short) - shift], short[shift:]
    return mixed(left * np.uint64(0xA24B_AED4_963E_E407) + (right ^ np.uint64(wanted)))


def level_lengths(first: int, last: int) -> list[int]:
    """first, then twice as long each time, ending at last."""
    lengths = [first]
    while lengths[-1] < last:
        lengths.append(min(2 * lengths[-1], last))
    return lengths


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    reach, least = 1, values
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
