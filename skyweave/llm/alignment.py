"""Token alignment across two tokenizers: byte ranges that overlap, and groups cut where tokens of both sides end.

The texts of an Arrow batch are encoded by both tokenizers and their tokens laid out by byte offset. pandas merge_asof, keyed by document, finds for
each token's start the token of the other side that covers it; the union of both directions is all overlaps, and equal ends close a group. Texts
are encoded by parts, cut at single spaces between letters, digits or common marks, where no token of either side reaches across (checked when
the vocabularies are loaded, as far as they decide it); a part that many texts share is encoded once a block.

Counts of id pairs over all documents: a block of texts keeps each pair once with its number of links, these are summed by pair, rated against
the highest count of their B id, and sent back to the blocks that have them, where each link looks its pair up. Blocks hold a bounded number of
characters; a longer text goes on in further blocks, and its sums are added at the end.

Null or empty texts, and texts whose tokens' bytes differ from a space and the text on either side: no tokens, zeros, and '' in place of the
digest. Null doc_id, repeated rows: each row gets its own result, and its links count. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.llm.common import materialize

SIDE_A, SIDE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Characters of texts that are aligned at once; about 150 bytes of memory each.
BLOCK_CHARS = 600_000
#: Bounds of the table of parts that a worker remembers: entries and their characters. New parts are encoded so many together.
REMEMBERED, REMEMBERED_CHARS, TOGETHER = 400_000, 8_000_000, 512
#: A single space that no token reaches across: what stands on its sides is no white space.
_LEFT = re.compile(r"(?<=[\w!-~]) ")
_CUT = re.compile(_LEFT.pattern + r"(?=[\w!-~])")


def _byte_letters() -> dict[str, int]:
    """The bytes that stand behind the letters of byte-level entries: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(0x100 + i): b for i, b in enumerate(rest)}}


def _piece_bytes(piece: str) -> bytes:
    return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode()


class Encoders:
    """Both tokenizers with the bytes of their entries, and the parts that they have encoded, in the order of `known`: the ids on both sides one after
    another, where each part's begin, and whether their bytes are a space and the part."""

    def __init__(self, side_a: str, side_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(public_tokenizers.path(side_a))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(side_b))
        letters = _byte_letters()
        entries = sorted(self.a.get_vocab().items(), key=lambda e: e[1])
        self.a_bytes = [b""] * (entries[-1][1] + 1)
        for entry, i in entries:
            self.a_bytes[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(_LEFT.search(p.replace("▁", " ")) for p in pieces) or any(_LEFT.search(e.decode(errors="replace")) for e in self.a_bytes):
            raise ValueError("tokens reach across a space")
        self.b_bytes = [_piece_bytes(p) for p in pieces]
        self.a_sizes, self.b_sizes = (np.array([len(e) for e in own]) for own in (self.a_bytes, self.b_bytes))
        self.names = [np.array([f"{i}{mark}" for i in range(len(own))], object) for own, marks in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for mark in marks]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.begins, self.sound, self.chars = [np.zeros(0, np.int64)] * 2, [np.zeros(1, np.int64)] * 2, np.zeros(0, bool), 0

    def _encoded(self, text: str) -> list[list[int]]:
        return [self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)]

    def _alike(self, ids: list[list[int]], text: bytes) -> bool:
        return all(b"".join(map(entries.__getitem__, own)) == text for own, entries in zip(ids, (self.a_bytes, self.b_bytes), strict=True))

    def _encode(self, parts: list[str]) -> list[tuple[list[list[int]], list[np.ndarray], bool]]:
        """Ids of both sides, their numbers in each part, and whether their bytes are the texts: of parts encoded as one text and cut at their ends, or in smaller
        groups where bytes differ or the text wouldn't be cut into these parts."""
        line = " ".join(parts)
        if len(parts) == 1 or _CUT.split(line) == parts:
            ids, own = self._encoded(line), [p.encode() for p in parts]
            if self._alike(ids, b" " + b" ".join(own)):
                upto = np.cumsum([len(p) + 1 for p in own])
                places = [np.searchsorted(np.cumsum(sizes[i]), upto) + 1 for i, sizes in zip(ids, (self.a_sizes, self.b_sizes), strict=True)]
                return [(ids, [np.diff(x, prepend=0) for x in places], True)]
            if len(parts) == 1:
                return [(ids, [np.array([len(i)]) for i in ids], False)]
        step = max(1, len(parts) // 8)
        return [x for i in range(0, len(parts), step) for x in self._encode(parts[i : i + step])]

    def slots(self, parts: list[str]) -> np.ndarray:
        """The places of parts, of which a text is made by single spaces, among the known; they hold until the next call."""
        distinct = dict.fromkeys(parts)
        new = [p for p in distinct if p not in self.known]
        chars = sum(map(len, new))
        if len(self.known) + len(new) > REMEMBERED or self.chars + chars > REMEMBERED_CHARS:
            self.forget()
            new = list(distinct)
            chars = sum(map(len, new))
        found = [x for i in range(0, len(new), TOGETHER) for x in self._encode(new[i : i + TOGETHER])]
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.chars += chars
        for side in (0, 1):
            self.ids[side] = np.concatenate([self.ids[side], *(np.array(ids[side], np.int64) for ids, _, _ in found)])
            counts = np.concatenate([np.zeros(0, np.int64), *(n[side] for _, n, _ in found)])
            self.begins[side] = np.concatenate([self.begins[side], self.begins[side][-1] + np.cumsum(counts)])
        self.sound = np.concatenate([self.sound, *(np.full(len(n[0]), good) for _, n, good in found)])
        return np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))

    def all_sound(self, parts: list[str]) -> bool:
        slot = self.slots(parts)
        return bool(self.sound[slot].all())


@lru_cache(1)
def encoders(side_a: str = SIDE_A, side_b: str = SIDE_B) -> Encoders:
    """One for each worker."""
    return Encoders(side_a, side_b)


def _laid_out(tools: Encoders, side: int, slot: np.ndarray, doc: np.ndarray) -> pd.DataFrame:
    """The tokens of parts, one after another: document, byte start and end, id, place."""
    begins, sizes = tools.begins[side], (tools.a_sizes, tools.b_sizes)[side]
    begin, n = begins[slot], begins[slot + 1] - begins[slot]
    at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    token = tools.ids[side][at]
    end = np.cumsum(sizes[token])
    return pd.DataFrame({"doc": np.repeat(doc, n), "start": end - sizes[token], "end": end, "id": token, "place": np.arange(len(token))})


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of tokens whose byte ranges overlap: the covering token of each start, from both sides."""
    keyed = lambda frame, name: frame[["doc", "start", "place"]].rename(columns={"place": name})
    of_a = pd.merge_asof(keyed(a, "i"), keyed(b, "j"), on="start", by="doc")
    of_b = pd.merge_asof(keyed(b, "j"), keyed(a, "i").assign(other=a["start"]), on="start", by="doc")
    of_b = of_b[of_b["other"] < of_b["start"]]  # equal starts are found from both sides
    i, j = (np.concatenate([of_a[c].to_numpy(), of_b[c].to_numpy()]).astype(np.int64) for c in "ij")
    return i, j


def _group_texts(tools: Encoders, a: pd.DataFrame, b: pd.DataFrame, n_docs: int) -> tuple[np.ndarray, list[str]]:
    """Groups of each document, and their ids as text, each group ended by a semicolon."""
    ends = np.intersect1d(a["end"].to_numpy(), b["end"].to_numpy(), assume_unique=True)
    group = [np.searchsorted(ends, side["end"].to_numpy()) for side in (a, b)]
    upto = [np.concatenate([[0], np.cumsum(np.bincount(g, minlength=len(ends)))]) for g in group]
    words = np.empty(len(a) + len(b), object)
    for side, frame in enumerate((a, b)):
        last = ends[group[side]] == frame["end"].to_numpy()
        own = frame["id"].to_numpy()
        place = np.arange(len(frame)) + upto[1 - side][group[side] + side]
        words[place] = np.where(last, tools.names[2 * side + 1][own], tools.names[2 * side][own])
    tokens = np.bincount(a["doc"], minlength=n_docs) + np.bincount(b["doc"], minlength=n_docs)
    bounds = np.concatenate([[0], np.cumsum(tokens)])
    closed = a["doc"].to_numpy()[np.isin(a["end"].to_numpy(), ends, assume_unique=True)]
    return np.bincount(closed, minlength=n_docs), ["".join(words[x:y].tolist()) for x, y in zip(bounds[:-1], bounds[1:], strict=True)]


def _planes(x: np.ndarray) -> bytes:
    """Numbers under 2**32, byte by byte, compressed."""
    return pa.compress(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), codec="zstd", asbytes=True)


def _of_planes(packed: bytes, n: int) -> np.ndarray:
    flat = pa.decompress(packed, 4 * n, codec="zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(flat, np.uint8).reshape(4, n).T).view("<u4").ravel()


_DOC = pa.struct([("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("sha", pa.string())])
_BLOCK = "block bigint, docs array<struct<row:bigint,doc_id:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,sha:string>>, a array<int>, b array<int>, n array<bigint>, links binary"


class Piece:
    """Some parts of a text, all of them unless it is long; the last piece of a text brings its digest."""

    def __init__(self, row: int, doc_id: int | None, parts: list[str], digest, last: bool):
        self.row, self.doc_id, self.parts, self.digest, self.last = row, doc_id, parts, digest, last


def _aligned(pieces: list[Piece], block: int, tools: Encoders) -> pa.RecordBatch:
    """A block's row: counts of its texts, its distinct id pairs with their numbers of links, and the pair of each link, by document."""
    slot = tools.slots([p for piece in pieces for p in piece.parts])
    doc = np.repeat(np.arange(len(pieces)), np.array([len(piece.parts) for piece in pieces], np.int64))
    unsound = np.bincount(doc[~tools.sound[slot]], minlength=len(pieces)) > 0
    slot, doc = slot[~unsound[doc]], doc[~unsound[doc]]
    a, b = (_laid_out(tools, side, slot, doc) for side in (0, 1))
    i, j = overlaps(a, b)
    n_groups, texts = _group_texts(tools, a, b, len(pieces))
    of = a["doc"].to_numpy()[i]
    order = np.argsort(of, kind="stable")
    keys, index, times = np.unique(a["id"].to_numpy()[i[order]] * len(tools.b_bytes) + b["id"].to_numpy()[j[order]], return_inverse=True, return_counts=True)
    often = np.argsort(-times, kind="stable")  # frequent pairs get small numbers, which compress better
    rank = np.empty(len(often), np.int64)
    rank[often] = np.arange(len(often))
    keys, times = keys[often], times[often]
    shas = []
    for piece, text in zip(pieces, texts, strict=True):
        if piece.digest is None:
            shas.append(hashlib.sha256(text[:-1].encode()).hexdigest() if text else "")
            continue
        piece.digest.update((text[:-1] if piece.last else text).encode())
        shas.append(piece.digest.hexdigest() if piece.last else None)
    counts = (np.bincount(x, minlength=len(pieces)).tolist() for x in (a["doc"], b["doc"], of))
    docs = [dict(zip(("row", "doc_id", "n_a", "n_b", "n_links", "n_groups", "sha"), (p.row, p.doc_id, *x), strict=True)) for p, *x in zip(pieces, *counts, n_groups.tolist(), shas, strict=True)]
    lists = [pa.array([x], pa.list_(kind)) for x, kind in ((keys // len(tools.b_bytes), pa.int32()), (keys % len(tools.b_bytes), pa.int32()), (times, pa.int64()))]
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([docs], pa.list_(_DOC)), *lists, pa.array([_planes(rank[index.ravel()])], pa.binary())], ["block", "docs", "a", "b", "n", "links"])


def _pieces(row: int, doc_id: int | None, text: str, tools: Encoders) -> Iterator[Piece]:
    """A text by pieces of BLOCK_CHARS or so. One of several pieces is encoded twice: all of it has to be sound before any of its links counts."""
    parts = _CUT.split(text) if text else []
    if len(text) <= BLOCK_CHARS or len(parts) < 2:
        yield Piece(row, doc_id, parts, None, True)
        return
    upto = np.cumsum([len(p) + 1 for p in parts]) // BLOCK_CHARS
    cuts = [0, *(np.flatnonzero(np.diff(upto)) + 1).tolist(), len(parts)]
    runs = [parts[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
    if not all(tools.all_sound(run) for run in runs):
        yield Piece(row, doc_id, [], None, True)
        return
    digest = hashlib.sha256()
    for k, run in enumerate(runs):
        yield Piece(row, doc_id, run, digest, k == len(runs) - 1)


def _blocks(side_a: str, side_b: str):
    def over(batches):
        tools, first = encoders(side_a, side_b), TaskContext.get().partitionId() << 33
        row = block = first
        held, chars = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                for piece in _pieces(row, doc_id.as_py(), text.as_py() or "", tools):
                    held.append(piece)
                    chars += 16 + sum(map(len, piece.parts))
                    if chars > BLOCK_CHARS:
                        yield _aligned(held, block, tools)
                        held, chars, block = [], 0, block + 1
                row += 1
        if held:
            yield _aligned(held, block, tools)

    return over


def _looked_up(batches):
    """(row, doc_id, counts, n_best, count_sum) of each document of a block, given the corpus-wide count of its pairs (place, count, best)."""
    for batch in batches:
        for docs, links, answers in zip(batch.column("docs"), batch.column("links"), batch.column("answers"), strict=True):
            docs, answers = docs.values, answers.values
            total = docs.field("n_links").to_numpy()
            counts, best = np.zeros((2, len(answers) if answers is not None else 0), np.int64)
            if len(counts):
                place = answers.field("i").to_numpy()
                counts[place], best[place] = answers.field("c").to_numpy(), answers.field("best").to_numpy()
            pair = _of_planes(links.as_py(), int(total.sum()))
            bounds = np.concatenate([[0], np.cumsum(total)])
            sums = [np.concatenate([[0], np.cumsum(x[pair])]) for x in (best, counts)]
            n_best, count_sum = (x[bounds[1:]] - x[bounds[:-1]] for x in sums)
            columns = [docs.field(k) for k in range(len(_DOC))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_best), pa.array(count_sum)], [*(f.name for f in _DOC), "n_best", "count_sum"])


def align(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", side_a: str = SIDE_A, side_b: str = SIDE_B) -> DataFrame:
    """One row per document: its id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    blocks = materialize(docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text")).mapInArrow(_blocks(side_a, side_b), _BLOCK))
    pairs = blocks.select("block", F.posexplode(F.arrays_zip("a", "b", "n")).alias("i", "p")).select("block", "i", "p.*")
    counted = materialize(pairs.groupBy("a", "b").agg(F.sum("n").alias("c")))
    rated = counted.join(counted.groupBy("b").agg(F.max("c").alias("top")), "b").select("a", "b", "c", (F.col("c") == F.col("top")).cast("bigint").alias("best"))
    answers = pairs.drop("n").join(rated, ["a", "b"]).groupBy("block").agg(F.collect_list(F.struct("i", "c", "best")).alias("answers"))
    found = blocks.select("block", "docs", "links").join(answers, "block", "left").select("docs", "links", F.coalesce("answers", F.expr("cast(array() as array<struct<i:int,c:bigint,best:bigint>>)")).alias("answers"))
    rows = found.mapInArrow(_looked_up, "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, sha string, n_best bigint, count_sum bigint")
    sums = [F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return rows.groupBy("row").agg(F.first("doc_id").alias(doc_id), *sums, F.max("sha").alias("groups_sha256")).drop("row")
