"""Quality rules by repetition coverage: characters inside duplicated n-grams and lines.

Rolling hashes of several n-gram lengths run over the words of a batch of texts at once in numpy; a
window counts as duplicated if its hash occurs twice or more in the same text, the first occurrence included.
Nothing is shuffled: one text decides about itself.

Null or empty text: all counts are 0, base_failed is true, kept is false. Repeated rows, ties: each row gets
its own, equal result. Null doc_id is carried along. Other columns are ignored by the query and kept by the filter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyweave.llm.common import code_points, mix, per_text, span_hashes, text_chunks, words

#: Words in a window, and the most of a text's word characters that duplicated windows of that length may cover.
NGRAM_COVERAGE = {3: 0.60, 4: 0.55, 5: 0.50, 6: 0.45, 8: 0.40, 10: 0.35}
#: The most of a text's word characters on lines that repeat an earlier line.
LINE_COVERAGE = 0.30
#: Symbols a word.
SYMBOLS_PER_WORD = 0.25
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_FIELDS = [(k, pa.int64()) for k in _COUNTS] + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("line_coverage", pa.float64()), ("ngram_coverage", pa.list_(pa.float64()))]
RESULT = "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,base_failed:boolean,kept:boolean,line_coverage:double,ngram_coverage:array<double>>"


def _duplicated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(twice, keys)
    return twice[np.minimum(at, len(twice) - 1)] == keys


def _lines(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte bounds of the lines that hold a word and equal an earlier line of their text."""
    breaks = np.flatnonzero(data == 10)
    filled = np.flatnonzero(offsets[1:] > offsets[:-1])
    begin = np.concatenate([offsets[filled], breaks + 1])
    stop = np.concatenate([breaks, offsets[filled + 1]])
    begin.sort()
    stop.sort()
    worded = np.searchsorted(starts, stop) > np.searchsorted(starts, begin)
    begin, stop = begin[worded], stop[worded]
    text = np.searchsorted(offsets, begin, "right") - 1
    keys = span_hashes(data, begin, stop) ^ salt[text]
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), bool)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return begin[again], stop[again], text[again]


def _measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    n = len(offsets) - 1
    starts, ends, bounds = words(data, offsets)
    points = code_points(data)
    chars = points[ends] - points[starts]
    count, total = np.diff(bounds), per_text(chars, bounds)
    salt = mix(np.arange(n, dtype=np.uint64) + np.uint64(77))
    text = np.repeat(np.arange(n), count)
    own = span_hashes(data, starts, ends)
    share = lambda x: np.divide(x, total, out=np.zeros(n), where=total > 0)
    out = {"n_words": count, "word_chars": total, "n_symbols": per_text(_SYMBOL[data], offsets)}
    window, size, coverage = own.copy(), 1, []
    for length in range(2, max(NGRAM_COVERAGE) + 1):
        room = len(own) - length + 1
        if room <= 0:
            window = own[:0]
        else:
            window = mix(window[:room] * np.uint64(0xD6E8FEB86659FD93) + own[length - 1 :])
        if length not in NGRAM_COVERAGE:
            continue
        covered = np.zeros(len(own) + 1, np.int64)
        if room > 0:
            whole = np.flatnonzero(text[:room] == text[length - 1 :])
            hit = whole[_duplicated(window[whole] ^ salt[text[whole]])]
            np.add.at(covered, hit, 1)
            np.add.at(covered, hit + length, -1)
        inside = np.cumsum(covered[:-1]) > 0
        coverage.append(share(per_text(chars * inside, bounds)))
        if length == 3:
            out["n_repeat_words"] = per_text(inside, bounds)
    begin, stop, where = _lines(data, offsets, starts, salt)
    out["n_dup_lines"] = np.bincount(where, minlength=n)
    upto = np.concatenate([[0], np.cumsum(chars)])
    on_lines = upto[np.searchsorted(starts, stop)] - upto[np.searchsorted(starts, begin)]
    out["line_coverage"] = share(np.bincount(where, weights=on_lines, minlength=n))
    out["ngram_coverage"] = np.stack(coverage, 1) if n else np.zeros((0, len(NGRAM_COVERAGE)))
    out["base_failed"] = (count < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * count)
    rejected = (out["ngram_coverage"] > np.array(list(NGRAM_COVERAGE.values()))).any(1)
    rejected |= (out["line_coverage"] > LINE_COVERAGE) | (out["n_symbols"] > SYMBOLS_PER_WORD * count)
    out["kept"] = ~out["base_failed"] & ~rejected
    return out


def _column(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    if pa.types.is_list(kind):
        wide = np.concatenate(parts) if parts else np.zeros((0, 1))
        return pa.ListArray.from_arrays(pa.array(np.arange(0, wide.size + 1, wide.shape[1]), pa.int32()), pa.array(wide.ravel()))
    return pa.array(np.concatenate(parts) if parts else [], kind)


def _report(text: pa.Array) -> pa.Array:
    parts = [_measure(*chunk) for chunk in text_chunks(text)]
    return pa.StructArray.from_arrays([_column([p[k] for p in parts], kind) for k, kind in _FIELDS], [k for k, _ in _FIELDS])


def quality_report(text: Column) -> Column:
    """Counts, coverages and verdicts of each text, as a struct."""
    return F.arrow_udf(_report, RESULT)(text)


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, the counts, coverages and verdicts."""
    return docs.select(F.col(doc_id), quality_report(F.col(text)).alias("report")).select(doc_id, "report.*")


def keep_good(docs: DataFrame, text: str | Column = "text") -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    return docs.where(quality_report(F.col(text) if isinstance(text, str) else text)["kept"])
