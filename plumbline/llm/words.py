"""Words of a text as bytes, and 64-bit hashes of word windows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from xxhash import xxh3_64_intdigest

# Lower-cases A-Z and leaves every other byte. bytes.split() then separates at 0x09-0x0D and 0x20, and at nothing else.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Also turns every ASCII byte that is neither letter nor digit into a space.
LOWER_ALNUM = bytes(32 if b < 128 and not chr(b).isalnum() else LOWER[b] for b in range(256))

_SHIFT = np.uint64(33)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) | 1 for i in range(32)], np.uint64)


def texts(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text of an Arrow column, one at a time; null is empty."""
    for value in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        yield value.as_py() or b""


def mixed(a: np.ndarray) -> np.ndarray:
    a = (a ^ (a >> _SHIFT)) * _MIX[0]
    a = (a ^ (a >> _SHIFT)) * _MIX[1]
    return a ^ (a >> _SHIFT)


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of ``width`` words; none if there are fewer words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:n] * _FACTORS[0]
    for i in range(1, width):
        total += hashes[i:i + n] * _FACTORS[i]
    return mixed(total)


def repeated(values: np.ndarray) -> np.ndarray:
    """For each value, whether it occurs more than once."""
    ordered = np.sort(values)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(values), bool)
    at = np.searchsorted(twice, values)
    return twice[np.minimum(at, len(twice) - 1)] == values


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Mask of the ``n`` words that lie in a window of ``width`` words beginning at one of ``starts``."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return np.cumsum(edge[:n]) > 0


def distinct(values: np.ndarray) -> np.ndarray:
    ordered = np.sort(values)
    return ordered[np.concatenate(([True], ordered[1:] != ordered[:-1]))] if len(ordered) else ordered
