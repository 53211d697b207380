"""Benchmark decontamination by q-gram lemma filtering.

Texts and benchmark items are folded to lower-case letters, digits and single spaces. An item longer than WINDOW characters
is cut into overlapping windows. Where a window of m characters occurs with at most k edits, it shares at least
m - q + 1 - k q q-grams with the text, all within 2 k + 1 neighbouring diagonals; so shared q-grams are counted in overlapping
bands of twice that width, bands that meet the bound are kept, and each is verified by an alignment inside the band.

The items are sent to the tasks in blocks of about BLOCK_CHARS characters, one pass over the documents for each block, so what is
broadcast is bounded however large the benchmark is. Items of fewer than MIN_CHARS folded characters are found
where they stand whole and without edits between word boundaries; items without letters and digits match nothing. Null or empty texts and items match nothing. Null doc_id, repeated rows: each row gets its own matches; equal pairs are
one row. Empty tables: no rows. Other columns are ignored by the query and kept by the filter.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyweave.llm.common import _power_tables, materialize, mix, text_chunks

#: Characters of a q-gram, share of edited characters allowed, folded characters of a window and of the shortest item that may be edited.
Q, EDITS, WINDOW, MIN_CHARS = 12, 0.06, 160, 40
#: Characters of the items of a block; a block takes about 75 bytes a character in each Python worker, and 4 MB.
BLOCK_CHARS = 1_500_000
MATCHES = "array<struct<item_id:bigint,start:bigint,stop:bigint,edits:int>>"
_FILTER_BITS = 22


@lru_cache(1)
def _folds() -> np.ndarray:
    """For each code point its lower-case letter or digit, or a space."""
    table = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalnum():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def fold(points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded code points of consecutive texts, the place each came from, and the texts' bounds among them."""
    folded = _folds()[points]
    before = np.empty(len(folded), np.uint32)
    before[:1], before[1:] = 32, folded[:-1]
    before[bounds[:-1][bounds[:-1] < len(before)]] = 32
    place = np.flatnonzero((folded != 32) | (before != 32))
    return folded[place], place, np.searchsorted(place, bounds)


def _sums(points: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(mix(points) * _power_tables(len(points) + 1)[0][: len(points)], out=sums[1:])
    return sums


def _hashes(sums: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the `length` characters from each of the places."""
    return mix((sums[at + length] - sums[at]) * _power_tables(len(sums))[1][at])


def grams(points: np.ndarray) -> np.ndarray:
    """Hashes of the q-grams that begin at each place."""
    n = len(points) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    return _hashes(_sums(points), np.arange(n), Q)


class Patterns:
    """Windows of a block of items, with an index of their q-grams."""

    def __init__(self, items: list[tuple[int, str]]):
        self.item, self.text, self.edits = [], [], []
        hashes, owner, place = [], [], []
        short: dict[int, dict[int, list[tuple[int, np.ndarray]]]] = {}
        for item_id, text in items:
            points = np.frombuffer((text or "").encode("utf-32-le"), np.uint32)
            folded, _, _ = fold(points, np.array([0, len(points)]))
            while len(folded) and folded[-1] == 32:
                folded = folded[:-1]
            if not len(folded):
                continue
            if len(folded) < MIN_CHARS:
                h = int(_hashes(_sums(folded), np.zeros(1, np.int64), len(folded))[0])
                short.setdefault(len(folded), {}).setdefault(h, []).append((item_id, folded))
                continue
            n = max(1, -(-2 * (len(folded) - WINDOW) // WINDOW) + 1) if len(folded) > WINDOW else 1
            for i in range(n):
                at = (len(folded) - WINDOW) * i // (n - 1) if n > 1 else 0
                window = folded[at : at + WINDOW]
                h = grams(window)
                hashes.append(h)
                owner.append(np.full(len(h), len(self.text)))
                place.append(np.arange(len(h)))
                self.item.append(item_id)
                self.text.append(window)
                self.edits.append(min(int(EDITS * len(window)), (len(window) - Q) // Q))
        #: Short items by length: their sorted hashes, and the items of each hash.
        self.short = {n: (np.array(sorted(by), np.uint64), by) for n, by in sorted(short.items())}
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hash = h[order]
        self.owner = np.concatenate(owner)[order] if hashes else np.zeros(0, np.int64)
        self.place = np.concatenate(place)[order] if hashes else np.zeros(0, np.int64)
        self.known = np.zeros(1 << _FILTER_BITS, bool)
        self.known[(self.hash >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        self.k = np.array(self.edits, np.int64)
        self.bound = np.array([len(t) - Q + 1 - k * Q for t, k in zip(self.text, self.edits, strict=True)], np.int64)


def align_all(patterns: np.ndarray, texts: np.ndarray, sizes: np.ndarray, low: np.ndarray, width: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edits, start, stop) of each pattern's best place in its text, of which the first `size` characters count, start minus pattern's begin
    on the `width` diagonals from `low` on; edits above k are k + 1. One step per pattern character over all pairs and diagonals."""
    one, d = 1 << 20, np.arange(width)
    far, steps = (k + 1) * one, d * one
    low, sizes = low[:, None], sizes[:, None]
    pair = np.arange(len(patterns))[:, None]
    state = np.where((low + d >= 0) & (low + d <= sizes), d, far)  # edits, and the diagonal that they begin on
    for i in range(patterns.shape[1]):
        at = i + low + d
        met = texts[pair, np.clip(at, 0, texts.shape[1] - 1)] == patterns[:, i : i + 1]
        new = np.where((at >= 0) & (at < sizes), state + np.where(met, 0, one), far)
        new[:, :-1] = np.minimum(new[:, :-1], state[:, 1:] + one)
        new = np.minimum.accumulate(new - steps, axis=1) + steps
        state = np.where((at >= -1) & (at < sizes), np.minimum(new, far), far)
    best = state.argmin(1)
    state = state[pair[:, 0], best]
    return np.minimum(state // one, k + 1), np.maximum(0, low[:, 0] + state % one), patterns.shape[1] + low[:, 0] + best


def align(pattern: np.ndarray, text: np.ndarray, low: int, high: int, k: int) -> tuple[int, int, int] | None:
    """As align_all for one pair and the diagonals low to high; None above k edits."""
    edits, start, stop = align_all(pattern[None], text[None], np.array([len(text)]), np.array([low]), high - low + 1, k)
    return (int(edits[0]), int(start[0]), int(stop[0])) if edits[0] <= k else None


def _short(folded: np.ndarray, limits: np.ndarray, patterns: Patterns) -> list[tuple[int, int, int, int]]:
    """(text, item_id, start, stop) in folded characters of the short items that stand between word boundaries."""
    if not patterns.short or not len(folded):
        return []
    edge = np.zeros(len(folded) + 1, bool)  # a word may end before each place, or begin there
    edge[:-1] = folded == 32
    edge[limits] = True
    begins = np.flatnonzero((edge[:-1] | np.r_[True, folded[:-1] == 32]) & (folded != 32))
    text = np.searchsorted(limits, begins, "right") - 1
    room, sums, found = limits[text + 1] - begins, _sums(folded), []
    for n, (hashes, by) in patterns.short.items():
        fits = np.flatnonzero(room >= n)
        fits = fits[edge[begins[fits] + n]]
        h = _hashes(sums, begins[fits], n)
        hit = np.flatnonzero(hashes[np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)] == h)
        for i, key in zip(fits[hit].tolist(), h[hit].tolist(), strict=True):
            a = int(begins[i])
            found += [(int(text[i]), item, a, a + n) for item, whole in by[key] if np.array_equal(whole, folded[a : a + n])]
    return found


def matches(points: np.ndarray, bounds: np.ndarray, patterns: Patterns) -> list[tuple[int, int, int, int, int]]:
    """(text, item_id, start, stop, edits) of the windows found, in code points of each text."""
    folded, place, limits = fold(points, bounds)
    found = [(t, item, int(place[a] - bounds[t]), int(place[b - 1] - bounds[t]) + 1, 0) for t, item, a, b in _short(folded, limits, patterns)]
    h = grams(folded)
    maybe = np.flatnonzero(patterns.known[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
    if not len(maybe):
        return found
    first, last = np.searchsorted(patterns.hash, h[maybe]), np.searchsorted(patterns.hash, h[maybe], "right")
    text = np.searchsorted(limits, maybe, "right") - 1
    good = (last > first) & (maybe + Q <= limits[text + 1])
    maybe, first, times, text = maybe[good], first[good], (last - first)[good], text[good]
    if not len(maybe):
        return found
    at = np.repeat(first - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum())
    where, text = np.repeat(maybe, times), np.repeat(text, times)
    owner, own_place = patterns.owner[at], patterns.place[at]
    step = 2 * patterns.k[owner] + 1
    band = (where - own_place) // step
    rows = np.concatenate([np.stack([text, owner, band - s, own_place], 1) for s in (0, 1)])
    rows = np.unique(rows, axis=0)
    heads = np.flatnonzero(np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(1)])
    shared = np.diff(np.r_[heads, len(rows)])
    candidates = rows[heads[shared >= patterns.bound[rows[heads, 1]]], :3]
    sizes = np.array([len(patterns.text[o]) for o in candidates[:, 1].tolist()], int)
    for m in np.unique(sizes).tolist():
        own = candidates[sizes == m]
        for i in range(0, len(own), 256):
            found += _verified(own[i : i + 256], folded, place, bounds, limits, patterns)
    return found


def _verified(candidates: np.ndarray, folded: np.ndarray, place: np.ndarray, bounds: np.ndarray, limits: np.ndarray, patterns: Patterns) -> list[tuple[int, int, int, int, int]]:
    """The matches among candidates (text, pattern, band) whose patterns are equally long."""
    text, owner, band = candidates.T
    k = int(patterns.k[owner[0]])
    windows = np.stack([patterns.text[o] for o in owner.tolist()])
    first, last = limits[text], limits[text + 1]
    low = band * (2 * k + 1) - first - k
    skipped = np.maximum(0, low - 1)
    begin, length = first + skipped, windows.shape[1] + 6 * k + 3
    size = np.clip(last - begin, 0, length)
    letters = folded[np.minimum(begin[:, None] + np.arange(length), len(folded) - 1)]
    edits, start, stop = align_all(windows, letters, size, low - skipped, 6 * k + 2, k)
    start, stop = np.minimum(begin + start, last - 1), np.minimum(begin + stop, last)
    good = np.flatnonzero(edits <= k)
    a, b = place[start] - bounds[text], place[stop - 1] - bounds[text] + 1
    return [(int(text[i]), patterns.item[owner[i]], int(a[i]), int(b[i]), int(edits[i])) for i in good.tolist()]


def _find(column: pa.Array, broadcast) -> pa.Array:
    patterns, rows = broadcast.value, []
    for data, offsets in text_chunks(column):
        lengths = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        own: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
        for text, item, a, b, edits in matches(points, lengths[offsets], patterns):
            own[text].append({"item_id": item, "start": a, "stop": b, "edits": edits})
        rows += own
    return pa.array(rows, pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("edits", pa.int32())])))


def found_in(text: Column, patterns) -> Column:
    """Matches of a broadcast block of patterns in each text."""
    return F.arrow_udf(lambda t: _find(t, patterns), MATCHES)(text)


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", limit: int = BLOCK_CHARS) -> list:
    """The items as broadcasts of about `limit` characters at most, of which one is on the driver at a time."""
    items = benchmark.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(text).alias("text")).where("length(text) > 0")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // limit)
    spark = benchmark.sparkSession
    return [spark.sparkContext.broadcast(Patterns([tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).collect()])) for i in range(n)]


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, start and stop of what its windows cover, edits of the best window."""
    out = None
    for block in blocks(benchmark):
        one = docs.select(F.col(doc_id), F.explode(found_in(F.col(text), block)).alias("m")).select(doc_id, "m.*")
        out = one if out is None else out.unionByName(one)
    if out is None:
        out = docs.select(F.col(doc_id)).limit(0).selectExpr(doc_id, "0L AS item_id", "0L AS start", "0L AS stop", "0 AS edits")
    return out.groupBy(doc_id, "item_id").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("edits").alias("edits"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents in which no item is found, with all their columns. With one block of items this is a filter; with more, each has a pass of its own that
    writes the digests of the texts in which it finds any, so that a worker holds one block at a time, and documents with such texts go."""
    patterns = blocks(benchmark)
    if len(patterns) == 1:
        return docs.where(F.size(found_in(F.col(text), patterns[0])) == 0)
    digest = F.md5(F.col(text))
    found = None
    for block in patterns:
        one = materialize(docs.where(F.size(found_in(F.col(text), block)) > 0).select(digest.alias("_found")).distinct())
        found = one if found is None else found.unionByName(one)
    if found is None:
        return docs
    found = found.distinct()
    return docs.join(found, F.md5(docs[text]) == found["_found"], "left_anti")
