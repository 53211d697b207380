"""Quality by perplexity under an interpolated modified Kneser-Ney model of character 4-grams, trained on trusted text.

Every character keeps its identity. Every task counts the n-grams of its trusted documents; the counts are summed in shards by
n-gram, and discounts, totals and probabilities of all orders are joins of these sums. The table holds the n-grams that occur and
the back-off weights of their contexts, under 64-bit hashes, in shards by hash; none of it passes through the driver. Each task asks for
the entries of the distinct n-grams of its documents, once however many documents hold them; the questions are joined to the shards,
and the answers meet the documents, packed and compressed, by task. So what is shuffled grows with the documents, and a task holds
the entries of one partition's n-grams only.

Trusted are documents with label quality 1; the model is fitted on all those of even hash of doc_id, however many, and the
quantiles are over all others, which it doesn't favour. Null text, or fewer than four characters: perplexity null, kept false. Null language:
a language like another. Documents of several labels are trusted if one of them is 1. Repeated rows: each row gets its own
result. A language without trusted documents, or with none among those the quantiles are over: the quantile of all languages. The documents are read
twice, and have to be in the same partitions both times, as tables and the results of joins, sorts and repartitioning by columns are; where a
partition holds other documents the second time, an error says so. Empty table: no rows. No trusted documents: thresholds are null and every document with a perplexity is kept. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.llm.common import materialize, mix, text_chunks

ORDER, BITS = 4, 21
MASK = (1 << BITS) - 1
#: Bytes of text packed into one row, and the most 4 KB parts of the bitmap of trusted ids, two bytes an id up to 16 MB; beyond that it lets
#: more documents through to the join, which is exact.
PACK_BYTES, BITMAP_PARTS = 4 << 20, 4096
#: The key under which a part's documents are told.
TOLD = 0x5AFE0D0C5
FLOOR = 1e-12
QUANTILE, MARGIN = 0.99, 1.02


def _points(data: np.ndarray) -> np.ndarray:
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last pair of characters of the n-grams at each place but a text's last three, and each text's bounds among them."""
    points = _points(data).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    n = len(points) - ORDER + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    pairs = points[:-1] << BITS | points[1:]
    whole = np.ones(n, bool)
    for i in range(1, ORDER):
        ends = bounds[1:] - i
        whole[ends[(ends >= 0) & (ends < n)]] = False
    place = np.flatnonzero(whole)
    return pairs[place], pairs[place + 2], np.searchsorted(place, bounds)


def _keys(tag, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of n-grams: tag is the order, or 4 more than the order for a context's back-off weight."""
    return mix(mix(np.asarray(a + (np.asarray(tag, np.int64) << 2 * BITS), np.uint64)) + np.asarray(b, np.uint64))


def _count(batches):
    for batch in batches:
        for data, offsets in text_chunks(batch.column(0)):
            a, b, _ = _grams(data, offsets)
            _, at, n = np.unique(_keys(ORDER, a, b), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(a[at]), pa.array(b[at]), pa.array(n.astype(np.int64))], ["a", "b", "n"])


def _discounts(*seen: float) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more, from how many n-grams have counts 1 to 4."""
    n1, n2, n3, n4 = (max(1.0, n) for n in seen)
    y = n1 / (n1 + 2 * n2)
    return np.clip([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], 0, [0, 0.99, 1.99, 2.99])


def kneser_ney(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of the last class of each n-gram after the others, for a table of n-gram counts with an axis for
    each place: modified Kneser-Ney discounts, interpolated over all lower orders down to the uniform distribution. For small
    tables; `train` gives the same numbers for those n-grams that occur."""
    levels = [counts.astype(float)]
    while levels[-1].ndim > 1:
        levels.append((levels[-1] > 0).sum(0).astype(float))  # continuation counts
    lower = np.full(counts.shape[-1], 1 / counts.shape[-1])
    for c in reversed(levels):
        cut = _discounts(*(float((c == i).sum()) for i in range(1, 5)))
        off = cut[np.minimum(c, 3).astype(int)]
        total = c.sum(-1, keepdims=True)
        back = np.divide(off.sum(-1, keepdims=True), total, out=np.ones_like(total), where=total > 0)
        lower = np.divide(c - off, total, out=np.zeros_like(c), where=total > 0) + back * lower
    return np.log(np.maximum(lower, FLOOR)).astype(np.float32)


def train(texts: DataFrame) -> tuple[DataFrame, float]:
    """The model of the trusted texts, a table of one string column: (k, v), hashes of n-grams and contexts and their log values, and the log
    probability of a character that doesn't occur."""
    a, b, n = F.col("a"), F.col("b"), F.col("n")
    context, suffix = F.shiftright("b", BITS), {4: a.bitwiseAND(F.lit(MASK)), 3: F.lit(0).cast("bigint"), 2: F.lit(0).cast("bigint")}
    levels = {ORDER: materialize(texts.select(texts.columns[0]).mapInArrow(_count, "a bigint, b bigint, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n")))}
    for m in range(ORDER, 1, -1):  # continuation counts
        last = b.bitwiseAND(F.lit(MASK)) if m == 2 else b
        levels[m - 1] = materialize(levels[m].groupBy(suffix[m].alias("a"), last.alias("b")).agg(F.count(F.lit(1)).alias("n")))
    seen = {m: t.agg(F.count(F.lit(1)), *(F.count_if(n == i) for i in range(1, 5))).first() for m, t in levels.items()}
    entries, lower = [], None
    uniform = 1 / (seen[1][0] + 1)
    for m in range(1, ORDER + 1):
        cut = [float(x) for x in _discounts(*map(float, seen[m][1:]))]
        off = F.when(n == 1, cut[1]).when(n == 2, cut[2]).otherwise(cut[3])
        level = levels[m].withColumn("h", context)
        totals = level.groupBy("a", "h").agg(F.sum("n").alias("total"), (F.sum(off) / F.sum("n")).alias("back"))
        p = level.join(totals, ["a", "h"])
        if m == 1:
            empty = (totals.first() or {"back": 1.0})["back"]
        else:
            last = b.bitwiseAND(F.lit(MASK)) if m == 2 else b
            p = p.withColumn("sa", suffix[m]).withColumn("sb", last).join(lower.select(F.col("a").alias("sa"), F.col("b").alias("sb"), F.col("p").alias("below")), ["sa", "sb"])
            entries.append(totals.select(F.lit(m + 4).alias("tag"), "a", F.col("h").alias("b"), F.col("back").alias("v")))
        below = F.col("below") if m > 1 else F.lit(uniform)
        lower = materialize(p.select("a", "b", ((n - off) / F.col("total") + F.col("back") * below).alias("p")))
        entries.append(lower.select(F.lit(m).alias("tag"), "a", "b", F.col("p").alias("v")))
    every = entries[0]
    for e in entries[1:]:
        every = every.unionByName(e)
    key = F.arrow_udf(lambda tag, a, b: pa.array(_keys(tag.to_numpy(zero_copy_only=False), a.to_numpy(), b.to_numpy()).view(np.int64)), "bigint")
    table = materialize(every.select(key("tag", "a", "b").alias("k"), F.log(F.greatest("v", F.lit(1e-300))).alias("v")))
    return table, float(np.log(max(empty * uniform, 1e-300)))


def _find(q: np.ndarray, keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(q), bool), np.zeros(len(q))
    at = np.minimum(np.searchsorted(keys, q), len(keys) - 1)
    hit = keys[at] == q
    return hit, np.where(hit, values[at], 0.0)


def _log_p(a: np.ndarray, b: np.ndarray, four: np.ndarray, keys: np.ndarray, values: np.ndarray, none: float) -> np.ndarray:
    """Log probabilities of distinct n-grams: of the longest suffix that occurs, and of the back-off from the longer ones."""
    hit, out = _find(four, keys, values)
    left = np.flatnonzero(~hit)
    for m in range(ORDER, 1, -1):
        x, y = a[left], b[left]
        full = x if m == 4 else x & MASK if m == 3 else x * 0
        out[left] += _find(_keys(m + 4, full, y >> BITS), keys, values)[1]
        less = m - 1
        hit, value = _find(_keys(less, x & MASK if less == 3 else x * 0, y & MASK if less == 1 else y), keys, values)
        out[left] += value
        left = left[~hit]
    out[left] += none
    return np.maximum(out, np.log(FLOOR))


def _asked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of all entries that the log probabilities of these n-grams may need: their suffixes, and the contexts of these."""
    out = []
    for m in range(ORDER, 0, -1):
        a, b = (a, b) if m == 4 else (a & MASK, b) if m == 3 else (a * 0, b) if m == 2 else (a, b & MASK)
        keys, first = np.unique(_keys(m, a, b), return_index=True)
        a, b = a[first], b[first]
        out.append(keys)
        if m > 1:
            out.append(_keys(m + 4, a, b >> BITS))
    return np.unique(np.concatenate(out))


def _told(rows: int, size: int) -> int:
    """What both passes must agree on about the documents of a part."""
    return (rows * 1_000_003 + size) % (1 << 62)


def _questions(batches):
    """(part, k, told): the entries that one partition's documents need, and one row, of key TOLD, that tells these documents."""
    part, known, rows, size = None, np.zeros(0, np.uint64), 0, 0
    for batch in batches:
        part = batch.column(0)[0].as_py() if len(batch) else part
        rows += len(batch)
        for data, offsets in text_chunks(batch.column(3)):
            size += len(data)
            a, b, _ = _grams(data, offsets)
            four, first = np.unique(_keys(ORDER, a, b), return_index=True)
            first = first[~_find(four, known, known)[0]]
            known = np.union1d(known, _asked(a[first], b[first])) if len(first) else known
    if part is not None:
        columns = [np.full(len(known) + 1, part, np.int32), np.append(known.view(np.int64), TOLD)]
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array([None] * len(known) + [_told(rows, size)], pa.int64())], ["part", "k", "told"])


def _packed(batches):
    """One partition's documents as compressed rows of kind 1."""
    for batch in batches:
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(batch.column(3)), 0).to_numpy(zero_copy_only=False))])
        at = 0
        while at < len(batch):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + PACK_BYTES, "right")) - 1)
            sink = pa.BufferOutputStream()
            docs = batch.slice(at, to - at).select([1, 2, 3])
            with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(docs)
            columns = ([batch.column(0)[0].as_py()], [1], [None], [None], [None], [sink.getvalue().to_pybytes()])
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [x.split()[0] for x in _MET.split(", ")])
            at = to


_MET = "part int, kind int, k bigint, v double, told bigint, docs binary"


def _scored(none: float):
    """Over rows of _MET by part, answers before documents: the documents with their perplexity."""

    def over(batches):
        part, keys, values, table, told, seen = None, [], [], None, None, [0, 0]

        def end():
            if part is not None and told != _told(*seen):
                raise RuntimeError(f"partition {part} held other documents when it was read again")

        for batch in batches:
            parts, kinds = (batch.column(i).to_numpy() for i in (0, 1))
            at = 0
            while at < len(batch):
                to = at + int(np.argmin(np.append((parts[at:] == parts[at]) & (kinds[at:] == kinds[at]), False)))
                if part is None or parts[at] != part:
                    end()
                    part, keys, values, table, told, seen = parts[at], [], [], None, None, [0, 0]
                if kinds[at] == 0:
                    own = batch.slice(at, to - at)
                    keys.append(own.column(2).to_numpy().view(np.uint64).copy())
                    values.append(own.column(3).to_numpy().copy())
                    told = next((x for x in own.column(4).drop_null().to_pylist()), told)
                else:
                    if table is None:
                        k, v = np.concatenate(keys), np.concatenate(values)
                        order = np.argsort(k)
                        table, keys, values = (k[order], v[order]), [], []
                    for i in range(at, to):
                        for docs in pa.ipc.open_stream(batch.column(5)[i].as_buffer()):
                            scores, size = _perplexities(docs.column(2), *table, none)
                            seen = [seen[0] + len(docs), seen[1] + size]
                            yield pa.RecordBatch.from_arrays([docs.column(0), docs.column(1), scores], ["doc_id", "lang", "perplexity"])
                at = to
        end()

    return over


def _perplexities(column: pa.Array, keys: np.ndarray, values: np.ndarray, none: float) -> tuple[pa.Array, int]:
    total, count, size = [np.zeros(0)], [np.zeros(0, np.int64)], 0
    for data, offsets in text_chunks(column):
        size += len(data)
        a, b, bounds = _grams(data, offsets)
        four, first, inverse = np.unique(_keys(ORDER, a, b), return_index=True, return_inverse=True)
        sums = np.concatenate([[0], np.cumsum(_log_p(a[first], b[first], four, keys, values, none)[inverse])])
        total.append(sums[bounds[1:]] - sums[bounds[:-1]])
        count.append(np.diff(bounds))
    total, count = np.concatenate(total), np.concatenate(count)
    return pa.array(np.exp(-total / np.maximum(count, 1)), mask=count == 0), size


def score(body: DataFrame, model: tuple[DataFrame, float]) -> DataFrame:
    """The rows of body (doc_id, lang, text) with perplexity in text's place. The body is read twice, and its partitions have to hold the same
    documents both times, as those of files do; the tasks check that."""
    table, none = model
    docs = body.select(F.spark_partition_id().alias("part"), "doc_id", "lang", "text")
    table = table.unionByName(table.sparkSession.createDataFrame([(TOLD, 0.0)], "k bigint, v double"))
    questions = docs.mapInArrow(_questions, "part int, k bigint, told bigint")
    answers = questions.join(table.hint("merge"), "k").select("part", F.lit(0).alias("kind"), "k", "v", "told", F.lit(None).cast("binary").alias("docs"))
    met = answers.unionByName(docs.mapInArrow(_packed, _MET)).repartition("part").sortWithinPartitions("part", "kind")
    types = dict(body.dtypes)
    return met.mapInArrow(_scored(none), f"doc_id {types['doc_id']}, lang {types['lang']}, perplexity double")


def _likely(ids: DataFrame, column: str):
    """A column that is true for all ids of the table, and for few others."""
    parts = min(BITMAP_PARTS, max(1, -(-16 * ids.count() // 32768)))
    place = lambda c: F.pmod(F.xxhash64(F.lit(5), F.col(c).cast("bigint")), F.lit(parts * 32768))
    own = ids.select(F.shiftright(place(column), 15).alias("part"), F.pmod(place(column), F.lit(32768)).alias("bit"))
    rows = own.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    bits = np.zeros((parts, 4096), np.uint8)
    for r in rows:
        bits[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    shared = ids.sparkSession.sparkContext.broadcast(bits.ravel())

    def held(places: pa.Array) -> pa.Array:
        at = places.to_numpy(zero_copy_only=False)
        return pa.array((shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))

    return lambda c: F.arrow_udf(held, "boolean")(place(c))


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", quantile: float = QUANTILE) -> DataFrame:
    """One row per document: doc_id, lang, perplexity, threshold, kept."""
    trusted = labels.where("quality = 1").select(F.col("doc_id").alias("_trusted")).distinct()
    fits = lambda c: F.pmod(F.xxhash64(F.col(c).cast("bigint")), F.lit(2)) == 0
    body = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    fitting = trusted.where(fits("_trusted") & F.col("_trusted").isNotNull())
    fitted = body.where(fits("doc_id")).where(_likely(fitting, "_trusted")("doc_id")).select("doc_id", "text").join(fitting.hint("merge"), F.col("doc_id") == F.col("_trusted"), "left_semi")
    scored = materialize(score(body, train(fitted.select("text"))))
    own = scored.join(trusted.where(~fits("_trusted")), F.col("doc_id") == F.col("_trusted"), "left_semi")
    cut = lambda: (F.percentile_approx("perplexity", quantile, 10000) * MARGIN).alias("threshold")
    by_lang = own.groupBy(F.col("lang").alias("_lang")).agg(cut())
    overall = own.agg(cut()).first()["threshold"]
    found = scored.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    threshold = F.coalesce("threshold", F.lit(overall).cast("double"))
    kept = F.coalesce(F.col("perplexity") <= threshold, F.col("perplexity").isNotNull())
    return found.select(F.col("doc_id").alias(doc_id), F.col("lang").alias(lang), "perplexity", threshold.alias("threshold"), kept.alias("kept"))
