"""License scans with a positional rare-token index, by DataFrame functions only.

Templates are short licence notices; the base phrases are templates too. Their words make the vocabulary; the inverse document
frequency of each is taken over all documents. The index holds, for each word, the templates it stands in, with its places. A file looks
up its own licence words of highest IDF: for each template whose mandatory words it holds, the highest of these. Each place of such a word in the
file gives a relative position, at which the template's words are intersected with the file's, and the mandatory phrase is
verified there. The score is the greatest share of a template's IDF found in place.

Words of the vocabulary are kept with their positions only for files that hold all mandatory words of some template; no other file
can hold its phrase. Null or empty text: no words, no labels, score 0. Null doc_id: a document like others. Rows that repeat a
doc_id are scanned as rows of their own. Ties of IDF go by word. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyweave.llm.common import materialize

#: What stands between words, and words.
GAP, WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Base phrases and labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Label, mandatory phrase, notice.
TEMPLATES = (
    ("mit", "mit license", "released under the mit license"),
    ("mit", "mit license", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "apache license", "licensed under the apache license version 2 0"),
    ("gpl", "general public license", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "general public license", "under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "lesser general public license", "this library is licensed under the gnu lesser general public license"),
    ("agpl", "affero general public license", "licensed under the gnu affero general public license"),
    ("bsd", "bsd license", "released under the bsd license"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "mozilla public license", "subject to the terms of the mozilla public license version 2 0"),
    ("cc-by", "cc by 4 0", "licensed under cc by 4 0"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-nd", "cc by nd", "licensed under cc by nd 4 0"),
    ("cc-by", "creative commons attribution", "licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "cc0 1 0", "dedicated to the public domain under cc0 1 0"),
    ("isc", "isc license", "released under the isc license"),
    ("proprietary", "all rights reserved", "copyright all rights reserved"),
)
_A_TO_Z = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: The only letter besides A-Z whose lower case is one of a-z.
KELVIN = "\u212a"


def _lower(text: Column) -> Column:
    """The text, A to Z in lower case, whatever becomes of other letters, but none of them becomes one of a to z."""
    return F.when(F.contains(text, F.lit(KELVIN)), F.translate(text, *_A_TO_Z)).otherwise(F.lower(text))


def _notices() -> list[tuple[str, list[str], list[str], int]]:
    """Label, words, mandatory words and where these begin, of each template; the base phrases come first."""
    out = []
    for label, phrase, notice in [*((label, p, p) for p, label in BASE), *TEMPLATES]:
        words, need = notice.split(), phrase.split()
        out.append((label, words, need, next(i for i in range(len(words)) if words[i : i + len(need)] == need)))
    return out


def postings(spark) -> DataFrame:
    """(template, label, word, place, mandatory): the words of the templates. As many rows as the templates above have words."""
    rows = [(t, label, w, i, at <= i < at + len(need)) for t, (label, words, need, at) in enumerate(_notices()) for i, w in enumerate(words)]
    return spark.createDataFrame(rows, "template int, label string, word string, place int, mandatory boolean")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spark, notices = docs.sparkSession, _notices()
    listed = F.array(*map(F.lit, sorted({w for _, words, _, _ in notices for w in words})))
    needs = sorted({tuple(sorted(set(need))) for _, _, need, _ in notices})
    needs = [n for n in needs if not any(set(m) < set(n) for m in needs)]  # who holds more holds these
    body = docs.select(F.col(doc_id).alias("doc_id"), F.array_remove(F.split(F.regexp_replace(_lower(F.coalesce(F.col(text), F.lit(""))), GAP, " "), " "), "").alias("words"))
    read = body.select("doc_id", F.size("words").cast("bigint").alias("n_words"), F.array_intersect(listed, "words").alias("present"), "words")
    holds = reduce(or_, (reduce(and_, (F.array_contains("present", w) for w in n)) for n in needs))
    read = read.select("doc_id", "n_words", "present", F.when(holds, F.col("words")).alias("words"))
    read = materialize(read.withColumn("row", F.monotonically_increasing_id()))
    n_docs = read.count()
    frequency = read.select(F.explode("present").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    index = postings(spark)
    idf = materialize(index.select("word").distinct().join(frequency, "word", "left").select("word", F.log((1 + F.lit(n_docs)) / (1 + F.coalesce("df", F.lit(0)))).alias("idf")))
    index = index.join(F.broadcast(idf), "word")
    whole = index.groupBy("template").agg(F.sum("idf").alias("total"), F.count_if("mandatory").alias("needed"), F.count_distinct(F.when(F.col("mandatory"), F.col("word"))).alias("distinct"))
    # the words each file looks up, and where their templates would begin
    likely = read.where("words is not null")
    mandatory = index.where("mandatory").groupBy("template", "word").agg(F.min("place").alias("place"), F.first("idf").alias("idf"))
    held = likely.select("row", F.explode("present").alias("word")).join(F.broadcast(mandatory), "word")
    highest = held.groupBy("row", "template").agg(F.count(F.lit(1)).alias("held"), F.max(F.struct("idf", "word", "place")).alias("r"))
    lookups = highest.join(F.broadcast(whole), "template").where("held = distinct").select("row", "template", F.col("r.word").alias("word"), F.col("r.place").alias("place"))
    found = materialize(likely.select("row", F.posexplode("words").alias("at", "word")).where(F.col("word").isin(*sorted({w for _, words, _, _ in notices for w in words}))))
    begins = lookups.join(found, ["row", "word"]).select("row", "template", (F.col("at") - F.col("place")).alias("begin"))
    placed = begins.join(F.broadcast(index), "template").withColumn("at", F.col("begin") + F.col("place")).join(found, ["row", "at", "word"])
    met = placed.groupBy("row", "template", "label", "begin").agg(F.sum("idf").alias("got"), F.count_if("mandatory").alias("n"))
    share = F.when(F.col("total") > 0, F.col("got") / F.col("total")).otherwise(1.0)
    passed = met.join(F.broadcast(whole), "template").where("n = needed").withColumn("score", share).withColumn("base", F.col("template") < len(BASE))
    of_base = lambda c: F.when(F.col("base"), F.col(c))
    by_row = passed.groupBy("row").agg(F.count_if("base").alias("n_base"), F.min(of_base("begin")).alias("first_word"), F.max(of_base("begin")).alias("last_word"), F.collect_set(of_base("label")).alias("own"), F.collect_set("label").alias("all"), F.max("score").alias("score"))
    joined = read.select("row", "doc_id", "n_words").join(by_row, "row", "left")
    said = lambda c: F.coalesce(F.array_join(F.array_sort(c), ","), F.lit(""))
    return joined.select(
        F.col("doc_id").alias(doc_id), "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        F.col("first_word").cast("bigint").alias("first_word"), F.col("last_word").cast("bigint").alias("last_word"),
        said("own").alias("base_labels"), said("all").alias("labels"), F.round(F.least(F.coalesce("score", F.lit(0.0)), F.lit(1.0)), 6).alias("score"),
    )
