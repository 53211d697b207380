"""Token counts of whole texts: pieces are counted once per distinct pre-token and joined to the pre-token frequencies of
each document; token ids are never kept.

A text is cut where no piece of the vocabulary can reach across: before a run of spaces and around line breaks. Merges
never cross such a cut, so the counts of the parts add up to the count of the whole. Each task counts the pieces of a
pre-token once for all documents of an Arrow batch, and remembers short pre-tokens in a table of bounded size; the join is
done by position in the batch's dictionary, so that nothing is shuffled.

Null or empty text: 0 bytes and 0 tokens. Null doc_id, repeated rows: each row gets its own result. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOCABULARY = "piece_bpe_32k.model"
LIMIT = 4096
#: Bounds of the table of pre-tokens that a worker remembers: entries, and characters of one of them.
REMEMBERED, REMEMBERED_CHARS = 300_000, 48
#: Characters of texts whose pre-tokens are gathered before pieces are counted.
GATHERED_CHARS = 4_000_000

_PRE_TOKEN = re.compile("\n|[ ▁]*[^ ▁\n]+|[ ▁]+")


@lru_cache(1)
def _pieces(vocabulary: str):
    """The library's processor, once per worker, and the table of what it has counted."""
    import public_tokenizers
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))
    crossing = [p for p in map(processor.id_to_piece, range(processor.get_piece_size())) if re.search("[^▁]▁", p) or "\n" in p]
    if crossing:
        raise ValueError(f"pieces reach across pre-tokens: {crossing[:3]}")
    return processor, {}


def count_pieces(pre_tokens: list[str], vocabulary: str = VOCABULARY) -> list[int]:
    """Pieces of each pre-token inside a text. A line break is put before it, as the library adds a space to a text's begin."""
    processor, _ = _pieces(vocabulary)
    lead = len(processor.encode("\n"))
    return [len(ids) - lead for ids in processor.encode(["\n" + p for p in pre_tokens], num_threads=1)]


def _counted(texts: list[str], vocabulary: str) -> list[int]:
    known = _pieces(vocabulary)[1]
    place: dict[str, int] = {}
    rows, frequency, sizes = [], [], []
    for text in texts:
        counts = Counter(_PRE_TOKEN.findall(" " + text)) if text else {}
        rows += [place.setdefault(p, len(place)) for p in counts]
        frequency += counts.values()
        sizes.append(len(counts))
    pieces = np.zeros(len(place), np.int64)
    unknown = []
    for p, i in place.items():
        if (n := known.get(p)) is None:
            unknown.append((p, i))
        else:
            pieces[i] = n
    if unknown:
        found = count_pieces([p for p, _ in unknown], vocabulary)
        if len(known) + len(unknown) > REMEMBERED:
            known.clear()
        for (p, i), n in zip(unknown, found, strict=True):
            pieces[i] = n
            if len(p) <= REMEMBERED_CHARS and len(known) < REMEMBERED:
                known[p] = n
    joined = np.concatenate([[0], np.cumsum(pieces[rows] * np.array(frequency, np.int64))]) if rows else np.zeros(1, np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return (joined[bounds[1:]] - joined[bounds[:-1]]).tolist()


def _count(column: pa.Array, vocabulary: str) -> pa.Array:
    out, gathered, chars = [], [], 0
    for value in column:
        gathered.append(value.as_py() or "")
        chars += len(gathered[-1])
        if chars > GATHERED_CHARS:
            out += _counted(gathered, vocabulary)
            gathered, chars = [], 0
    return pa.array(out + _counted(gathered, vocabulary), pa.int64())


def n_tokens(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Tokens of each text, without begin, end or added special tokens."""
    return F.arrow_udf(lambda t: _count(t, vocabulary), "bigint")(text)


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """One row per document: its id, n_bytes, n_tokens, over_limit."""
    body = F.coalesce(F.col(text), F.lit(""))
    counted = docs.select(F.col(doc_id), F.octet_length(body).cast("bigint").alias("n_bytes"), n_tokens(body, vocabulary).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
