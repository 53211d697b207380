"""Numpy views of Arrow text columns and hashing; the shared folder for intermediate tables is that of skyweave.sources.shared."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from skyweave.sources.shared import clear, intermediates, materialize, shared_dir  # noqa: F401

#: Most bytes of text that one numpy pass takes, but for a single longer text.
CHUNK_BYTES = 1 << 20
#: Most bytes that are hashed at once, at 50 bytes of memory each, but for a single longer span.
HASHED_BYTES = 1 << 18

_BASE = 0x9E3779B97F4A7C15
_PRIME, _LOW31, _LOW30 = np.uint64((1 << 61) - 1), np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Splitmix64's finalizer."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_chunks(column: pa.Array):
    """(bytes, offsets) of consecutive texts, about CHUNK_BYTES at a time; null is the empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
        yield data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, cut where a text begins."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = np.zeros(n + 1, bool)
    begins[offsets] = True
    after = np.empty(n, bool)
    after[0], after[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~after | begins[:-1]))
    before = np.empty(n, bool)
    before[-1], before[:-1] = False, inside[1:]
    return starts, np.flatnonzero(inside & (~before | begins[1:])) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words `[^\\x20\\x09-\\x0D]+`, and where each text's words begin among them."""
    starts, ends = runs(~_SPACE[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def code_points(data: np.ndarray) -> np.ndarray:
    """Code points before each byte position, one more than there are bytes."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])


_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < n:
        size = max(n, CHUNK_BYTES + 4096)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table)
    return _powers["up"], _powers["down"]


def _times(x: np.ndarray, y: np.ndarray | np.uint64) -> np.ndarray:
    """x * y modulo 2**61 - 1, for values under that."""
    half = np.uint64(31)
    x1, x0, y1, y0 = x >> half, x & _LOW31, y >> half, y & _LOW31
    mid = x1 * y0 + x0 * y1
    return _residue(np.uint64(2) * x1 * y1 + (mid >> np.uint64(30)) + ((mid & _LOW30) << half) + x0 * y0)


def _residue(x: np.ndarray) -> np.ndarray:
    x = (x & _PRIME) + (x >> np.uint64(61))
    return np.where(x >= _PRIME, x - _PRIME, x)


_residues: dict[str, np.ndarray] = {}


def _residue_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base modulo 2**61 - 1, and of its inverse."""
    if not _residues or len(_residues["up"]) < n:
        size = max(n, HASHED_BYTES + 4096)
        for name, base in (("up", _BASE % int(_PRIME)), ("down", pow(_BASE, -1, int(_PRIME)))):
            table = np.ones(1, np.uint64)
            while len(table) < size:
                table = np.concatenate([table, _times(table, np.uint64(pow(base, len(table), int(_PRIME))))])
            _residues[name] = table[:size].copy()
    return _residues["up"], _residues["down"]


def _prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values under 2**40, each equal to the whole sum modulo 2**61 - 1 and under 2**63."""
    sums, step = np.zeros(len(values) + 1, np.uint64), 1 << 21
    for i in range(0, len(values), step):
        part = sums[i + 1 : i + 1 + step]
        np.cumsum(values[i : i + step], out=part)
        part += sums[i] % _PRIME
    return sums


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of the bytes in [start, end), by prefix sums of a polynomial modulo 2**61 - 1: unlike one modulo a power of two, it
    has no texts that are equal under every base."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + HASHED_BYTES)))
        a, b = int(starts[i]), int(ends[i:j].max())
        part = data[a:b]
        up, down = _residue_tables(b - a + 1)
        codes = (_LOWER[part] if lower else part).astype(np.uint64) + np.uint64(1)
        high, low = _prefix(codes * (up[: b - a] >> np.uint64(31))), _prefix(codes * (up[: b - a] & _LOW31))
        s, e = starts[i:j] - a, ends[i:j] - a

        def upto(at, high=high, low=low):
            top = _residue(high[at])
            return _residue(((top & _LOW30) << np.uint64(31)) + (top >> np.uint64(30)) + _residue(low[at]))

        out[i:j] = _times(_residue(upto(e) + (_PRIME - upto(s))), down[s])
        i = j
    return mix(out)


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values between consecutive bounds."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[bounds[1:]] - sums[bounds[:-1]]
