"""Near duplicates by SuperMinHash: signatures, banding, verification on full shingle sets, union-find grouping.

Each element of a set gets a pseudo-random permutation of the slots; the element at rank j of slot k offers the
value j + r with r in [0, 1), and the slot keeps the least offer. Ranks are taken in rounds over a whole batch of
sets: what round j offers exceeds all that earlier rounds offered, so a set is done as soon as its slots are filled.

Texts with equal sets form a class, and only one text of a class goes on. Bands of slots make buckets. Members of a
bucket whose signatures agree enough to be similar are joined by union-find into families; the pairs of a family whose signatures
agree enough are confirmed on full shingle sets, unless confirmed links join the two already; confirmed links are grouped by union-find.
Buckets and families of more than a block are dealt into blocks that share a few anchors, so that the blocks of a group of near copies
are linked. What then still lies in different components of the same large family, or in different families of the same large
bucket, is compared by signatures, block by block, and the texts of blocks that have pairs that agree are sent there to be confirmed: no link
is left out, and the members of the group's largest part aren't compared with each other again.

Null or empty text, or text without words: an empty set, linked with nothing. A single word: the sequence of one
word is the only shingle. Null doc_id: its text is linked with nothing, component_id is null, kept is true. Rows
that repeat a doc_id are one document: their texts' links add up, and each row is returned. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyweave.llm.common import materialize, mix, per_text, span_hashes, text_chunks, words

#: Slots of a signature (a prime, so that k -> a * k + b permutes them, under 256, so that counts of slots are bytes), and rows a band. At similarity 0.8 a pair
#: shares no band with probability (1 - 0.8 ** 5) ** 42 = 6e-8.
SLOTS, BAND_ROWS = 211, 5
#: Agreement of signatures below which a pair isn't confirmed on full sets: five standard errors under 0.8.
LEAST_AGREEMENT = 0.66
#: Texts, and shingles, of a bucket or family that are compared at once, and texts of a larger one that all its blocks hold.
BLOCK, BLOCK_SHINGLES, ANCHORS = 512, 400_000, 16
#: Parts in which the members of a class are counted before they meet.
SALTS = 64
#: Texts to fetch whose ids are broadcast, 2 MB of them; more are joined by shuffle.
FEW_TEXTS = 100_000
THRESHOLD_PERCENT = 80

_GOLDEN, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
SIGNED = "struct<n_shingles:bigint,set_a:bigint,set_b:bigint,slots:binary,bands:array<bigint>>"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles of `size` lower-cased words."""
    starts, ends, bounds = words(data, offsets)
    own = span_hashes(data, starts, ends, lower=True)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        w = own[a:b]
        k = min(size, len(w))
        h = w[: len(w) - k + 1].copy()
        for i in range(1, k):
            h = mix(h * np.uint64(0xD6E8FEB86659FD93) + w[i : len(w) - k + 1 + i])
        out.append(np.unique(h + np.uint64(k)))
    return out


def superminhash(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """Signatures, a row for each set; rows of empty sets hold only the largest value."""
    sig = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    live = np.flatnonzero([len(s) > 0 for s in sets])
    if not len(live):
        return sig
    element = np.concatenate([sets[i] for i in live])
    row = np.repeat(np.arange(len(live)), [len(sets[i]) for i in live])
    step = (mix(element ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(slots - 1)).astype(np.int64) + 1
    slot = (mix(element ^ np.uint64(0x5DEECE66D1234567)) % np.uint64(slots)).astype(np.int64)
    part = sig[live]
    for rank in range(slots):
        offer = (np.uint64(rank) << np.uint64(32)) | (mix(element + np.uint64((rank + 1) * _GOLDEN & _MASK)) >> np.uint64(32))
        np.minimum.at(part.reshape(-1), row * slots + slot, offer)
        unfilled = part.max(1) == np.iinfo(np.uint64).max
        if not unfilled.all():
            sig[live] = part
            if not unfilled.any():
                break
            going = unfilled[row]
            element, step, slot = element[going], step[going], slot[going]
            row = (np.cumsum(unfilled) - 1)[row[going]]
            live, part = live[unfilled], part[unfilled]
        slot = (slot + step) % slots
    else:
        sig[live] = part
    return sig


def _sign(text: pa.Array, size: int) -> pa.Array:
    n, a, b, slots, bands = [], [], [], [], []
    n_bands = SLOTS // BAND_ROWS
    for data, offsets in text_chunks(text):
        sets = shingle_sets(data, offsets, size)
        sig = superminhash(sets)
        n += [len(s) for s in sets]
        a += [int(mix(s).sum().astype(np.int64)) if len(s) else 0 for s in sets]
        b += [int(mix(s ^ np.uint64(_GOLDEN)).sum().astype(np.int64)) if len(s) else 0 for s in sets]
        slots += [x.tobytes() for x in sig.astype(np.uint8)]
        key = np.zeros((len(sets), n_bands), np.uint64) + np.arange(n_bands, dtype=np.uint64)
        for i in range(BAND_ROWS):
            key = mix(key * np.uint64(0xD6E8FEB86659FD93) + sig[:, i : i + n_bands * BAND_ROWS : BAND_ROWS])
        bands.append(key.view(np.int64))
    flat = np.concatenate(bands) if bands else np.zeros((0, n_bands), np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, flat.size + 1, n_bands), pa.int32()), pa.array(flat.ravel()))
    return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(slots, pa.binary()), lists], ["n_shingles", "set_a", "set_b", "slots", "bands"])


def signature(text: Column, size: int = 2) -> Column:
    """n_shingles, a 128-bit digest of the set, the signature's low bytes and its band keys."""
    return F.arrow_udf(lambda t: _sign(t, size), SIGNED)(text)


def _pairs_batch(found: list[tuple], names: tuple[str, ...] = ("a", "b")) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(len(names))], list(names))


def _top(up: dict[int, int], x: int) -> int:
    while (y := up.setdefault(x, x)) != x:
        up[x] = up.setdefault(y, y)
        x = up[x]
    return x


def _forest(batches):
    """Union-find over a partition's links: one row (node, least node of its tree) for each node that isn't the least."""
    up: dict[int, int] = {}
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = _top(up, a), _top(up, b)
            up[max(a, b)] = min(a, b)
    yield _pairs_batch([(x, top) for x in up if (top := _top(up, x)) != x])


def components(links: DataFrame) -> DataFrame:
    """(node, component): for each linked node the least node it reaches. Partitions are merged by union-find first, then
    large-star and small-star rounds run until the links form stars."""
    mark = lambda edges: edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    stars = materialize(links.select("a", "b").mapInArrow(_forest, "a bigint, b bigint").distinct())
    before = mark(stars)
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.where("a <> b").distinct()
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        stars = materialize(small.where("a <> b").distinct())
        last, before = before, mark(stars)
        if before == last:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _tree(n: int, near) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the graph in which near(i, rest) are those of rest that are joined to i."""
    rest, edges = np.arange(n), []
    while len(rest):
        front, rest = [int(rest[0])], rest[1:]
        while front and len(rest):
            i = front.pop()
            found = near(i, rest)
            edges += [(i, int(j)) for j in found]
            front += [int(j) for j in found]
            rest = np.setdiff1d(rest, found, assume_unique=True)
    return edges


def _agreeing(signs: np.ndarray):
    return lambda i, rest: rest[(signs[rest] == signs[i]).view(np.uint8).sum(1, dtype=np.uint8) >= LEAST_AGREEMENT * SLOTS]


def _similar(signs: np.ndarray, sets: list[np.ndarray], percent: int):
    """Joined are those whose signatures agree enough and whose full sets are similar enough."""
    agreeing, sizes = _agreeing(signs), np.array([len(x) for x in sets])

    def near(i: int, rest: np.ndarray) -> np.ndarray:
        rest = agreeing(i, rest)
        if not len(rest):
            return rest
        others = np.concatenate([sets[j] for j in rest])
        at = np.minimum(np.searchsorted(sets[i], others), sizes[i] - 1)
        both = per_text(sets[i][at] == others, np.concatenate([[0], np.cumsum(sizes[rest])]))
        return rest[100 * both >= percent * (sizes[rest] + sizes[i] - both)]

    return near


def _grouped(columns: list[str], edges, names: tuple[str, ...] = ("a", "b")):
    """For mapInArrow over rows sorted by their first five columns, of which three are the group and two the text: edges(rows) of each
    group, before them the group where the names are its columns; a text that repeats counts once."""
    keyed = names[:3] == tuple(columns[:3])

    def over(batches):
        at, held = None, []
        done = lambda: [(*at, *e) if keyed else e for e in edges(held)] if len(held) > 1 else []
        for batch in batches:
            found = []
            for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                if row[:3] != at:
                    found += done()
                    at, held = row[:3], []
                if not held or held[-1][:2] != row[3:5]:
                    held.append(row[3:])
            yield _pairs_batch(found, names)
        yield _pairs_batch(done(), names)

    return over


def _signs(held: list[tuple]) -> np.ndarray:
    return np.frombuffer(b"".join(x[2] for x in held), np.uint8).reshape(len(held), SLOTS)


def _alike(held: list[tuple]) -> list[tuple[int, int]]:
    return [(held[i][0], held[j][0]) for i, j in _tree(len(held), _agreeing(_signs(held)))]


def _sets(texts: list[str], size: int) -> list[np.ndarray]:
    return [x for chunk in text_chunks(pa.array(texts, pa.large_string())) for x in shingle_sets(*chunk, size)]


def _confirmed(size: int, percent: int):
    def edges(held: list[tuple]) -> list[tuple[int, int]]:
        return [(held[i][0], held[j][0]) for i, j in _tree(len(held), _similar(_signs(held), _sets([x[3] for x in held], size), percent))]

    return edges


def _parts(held: list[tuple]):
    """(i, those after i, or in the largest part, that lie in another part and whose signatures agree enough) for each text i out of the
    largest part."""
    agreeing, own = _agreeing(_signs(held)), np.array([x[3] for x in held])
    names, sizes = np.unique(own, return_counts=True)
    main, place = own == names[sizes.argmax()], np.arange(len(held))
    for i in np.flatnonzero(~main).tolist():
        yield i, agreeing(i, np.flatnonzero((own != own[i]) & (main | (place > i))))


def _apart(held: list[tuple]) -> list[tuple[int, int, int]]:
    """The texts (id, th, c) of pairs of different parts whose signatures agree enough."""
    met = np.zeros(len(held), bool)
    for i, rest in _parts(held):
        met[rest] = True
        met[i] |= len(rest) > 0
    return [(held[i][0], held[i][1], held[i][3]) for i in np.flatnonzero(met).tolist()]


def _linked(size: int, percent: int):
    """Links of full sets between different parts, but for those parts that links join already."""

    def edges(held: list[tuple]) -> list[tuple[int, int]]:
        sets, up, found = _sets([x[4] for x in held], size), {}, []
        similar = _similar(_signs(held), sets, percent)
        for i, rest in _parts(held):
            apart = np.array([j for j in rest.tolist() if _top(up, held[j][3]) != _top(up, held[i][3])], int)
            for j in similar(i, apart).tolist():
                x, y = sorted((_top(up, held[i][3]), _top(up, held[j][3])))
                if x != y:
                    up[y] = x
                    found.append((held[i][0], held[j][0]))
        return found

    return edges


def _in_blocks(rows: DataFrame, n: Column, blocks: Column, *salt: Column) -> DataFrame:
    """Each row in a block of its group, as column i, and about ANCHORS rows of a group of several blocks in all of them."""
    many = F.greatest(blocks, F.lit(1)).cast("int")
    anchor = (many > 1) & (F.pmod(F.xxhash64(F.lit(7), "id", "th"), n) < ANCHORS)
    own = F.array(F.pmod(F.xxhash64("id", "th", *salt), many).cast("int"))
    return rows.withColumn("i", F.explode(F.when(anchor, F.sequence(F.lit(0), many - 1)).otherwise(own))).withColumn("j", F.lit(0))


def _dealt(rows: DataFrame, columns: list[str], edges, names: tuple[str, ...] = ("a", "b")) -> DataFrame:
    sort = columns[:5]
    return rows.select(*columns).repartition(*sort[:3]).sortWithinPartitions(*sort).mapInArrow(_grouped(columns, edges, names), ", ".join(f"{n} bigint" for n in names)).distinct()


def _left_apart(own: DataFrame, signs: DataFrame) -> DataFrame:
    """(key, i, j, id, th, c): the texts of groups (key, id, th, m, c), m being their shingles, by the blocks of the group that are to be compared,
    that have a text of another part c there whose signature agrees enough. Members of a group's largest part are held against the others only."""
    size = own.groupBy("key", "c").agg(F.count(F.lit(1)).alias("n"), F.sum("m").alias("m"))
    main = size.groupBy("key").agg(F.max(F.struct("n", "c", "m")).alias("most"), F.sum("n").alias("n"), F.sum("m").alias("m"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    blocks = lambda n, m: F.ceil(F.greatest(n / BLOCK, m / BLOCK_SHINGLES)).cast("int")
    met = own.join(main.select("key", F.col("most.c").alias("most"), blocks(F.col("most.n"), F.col("most.m")).alias("mains"), blocks(F.col("n") - F.col("most.n"), F.col("m") - F.col("most.m")).alias("others")), "key")
    of_main = F.col("c") == F.col("most")
    block = F.pmod(F.xxhash64("id", "th"), F.when(of_main, F.col("mains")).otherwise(F.col("others"))).cast("int")
    spot = lambda main, i, j: F.struct(main.alias("main"), i.alias("i"), j.alias("j"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    others = F.concat(F.transform(upto("others"), lambda j: spot(F.lit(0), F.least("block", j), F.greatest("block", j))), F.transform(upto("mains"), lambda j: spot(F.lit(1), F.col("block"), j)))
    dealt = met.withColumn("block", block).withColumn("s", F.explode(F.when(of_main, F.transform(upto("others"), lambda i: spot(F.lit(1), i, F.col("block")))).otherwise(others)))
    rows = dealt.select(F.xxhash64("key", "s.main").alias("key"), "s.i", "s.j", "id", "th", "c").join(signs, ["id", "th"])
    return _dealt(rows, ["key", "i", "j", "id", "th", "slots", "c"], _apart, ("key", "i", "j", "id", "th", "c"))


def _confirm_apart(apart: DataFrame, docs: DataFrame, signs: DataFrame, size: int, percent: int) -> DataFrame:
    """The links (a, b) among the texts that _left_apart gives, on full sets."""
    needed = apart.select("id", "th").distinct()
    needed = F.broadcast(needed) if needed.count() <= FEW_TEXTS else needed
    texts = docs.join(needed, ["id", "th"]).dropDuplicates(["id", "th"]).join(signs, ["id", "th"])
    return _dealt(apart.join(texts, ["id", "th"]), ["key", "i", "j", "id", "th", "slots", "c", "text"], _linked(size, percent))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 2, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    docs = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("th"))
    signed = materialize(docs.withColumn("s", signature(F.col("text"), size)).select("id", "th", "s.*"))
    known = signed.where("id is not null and n_shingles > 0")
    # classes: first the least of each salted part, then of these
    digest, own = ["set_a", "set_b", "n_shingles"], F.struct("id", "th")
    parted = known.select("id", "th", *digest, F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt"))
    parted = materialize(parted.withColumn("part", F.min(own).over(Window.partitionBy(*digest, "salt"))))
    local = materialize(parted.where(own == F.col("part")).withColumn("rep", F.min(own).over(Window.partitionBy(*digest))))
    link = lambda rows, to: rows.where(F.col("id") != F.col(f"{to}.id")).select(F.col("id").alias("a"), F.col(f"{to}.id").alias("b"))
    twins = link(parted, "part").unionByName(link(local, "rep"))
    first = known.select("id", "th", "n_shingles", "slots", "bands").join(local.where(own == F.col("rep")).select("id", "th"), ["id", "th"], "left_semi")
    first = materialize(first.dropDuplicates(["id", "th"]))
    signs = first.select("id", "th", "slots")
    # families, by buckets
    keys = first.select("id", "th", F.explode("bands").alias("band"))
    weights = first.select("id", "th", F.col("n_shingles").alias("m"))
    buckets = keys.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialize(keys.join(buckets, "band"))
    dealt = _in_blocks(shared, F.col("n"), F.ceil(F.col("n") / BLOCK), F.col("band"))
    stars = components(_dealt(dealt.join(signs, ["id", "th"]), ["band", "i", "j", "id", "th", "slots"], _alike))
    family = stars.select(F.col("node").alias("id"), F.col("component").alias("family")).unionByName(stars.select(F.col("component").alias("id"), F.col("component").alias("family")).distinct())
    member = first.select("id", "th", "n_shingles").join(family, "id")
    extent = member.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("m"))
    member = member.join(extent, "family").withColumn("blocks", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("m") / BLOCK_SHINGLES)))
    member = materialize(member.select("family", "id", "th", "n", "blocks"))
    # confirmation, by families
    dealt = _in_blocks(docs.join(member.join(signs, ["id", "th"]).hint("shuffle_hash"), ["id", "th"]), F.col("n"), F.col("blocks"))
    links = _dealt(dealt, ["family", "i", "j", "id", "th", "slots", "text"], _confirmed(size, percent))
    stars = components(links.unionByName(twins))
    # what blocks have kept apart
    part = F.coalesce("c", "id").alias("c")
    buckets = shared.where(F.col("n") > BLOCK).join(member.select("id", "th", F.col("family").alias("c")), ["id", "th"], "left").select(F.xxhash64(F.lit(0), "band").alias("key"), "id", "th", part)
    families = member.where("blocks > 1").join(stars.select(F.col("node").alias("id"), F.col("component").alias("c")), "id", "left").select(F.xxhash64(F.lit(1), "family").alias("key"), "id", "th", part)
    large = materialize(buckets.unionByName(families))
    if not large.isEmpty():
        apart = materialize(_left_apart(large.join(weights, ["id", "th"]), signs))
        if not apart.isEmpty():
            stars = components(_confirm_apart(apart, docs, signs, size, percent).unionByName(stars.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    grouped = signed.select("id", "n_shingles").join(stars.withColumnRenamed("node", "id"), "id", "left")
    component = F.coalesce("component", "id")
    return grouped.select(F.col("id").alias(doc_id), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 2) -> DataFrame:
    """The documents kept of each group, with all their columns; rows with a null doc_id stay."""
    gone = near_duplicates(docs, doc_id, text, size).where(~F.col("kept")).select(F.col(doc_id).alias("_gone")).distinct()
    return docs.join(gone, docs[doc_id] == gone["_gone"], "left_anti")
