"""Edits of whole label files: a file is changed in all its lines or in none."""

from __future__ import annotations

import difflib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def places_of(names: list[str], remove: list[str]) -> list[int]:
    """The places of the names to remove. Unknown names are an error that says which were meant, and so is removing all or none."""
    wanted = list(dict.fromkeys(n.strip() for n in remove if n.strip()))
    if not wanted:
        raise ValueError("no keypoint names to remove")
    if unknown := [n for n in wanted if n not in names]:
        close = {n: difflib.get_close_matches(n, names, n=3, cutoff=0.4) for n in unknown}
        raise ValueError("unknown keypoint names: " + "; ".join(n + (f" (did you mean {', '.join(c)}?)" if c else "") for n, c in close.items()))
    if len(wanted) == len(names):
        raise ValueError("at least one keypoint has to remain")
    return [names.index(n) for n in wanted]


def drop_from_files(lines: DataFrame, names: list[str], remove: list[str], path: str = "path") -> DataFrame:
    """Label lines (path, line_no, text) with text, error, file_error and changed: each line without the named keypoints, unless any line of its file
    can't be read as one of these names' keypoints; then error says why, file_error is true for the whole file and its lines stay as they are. Blank lines,
    and null ones, stay. Lines of a null path are one file."""
    drop = places_of(names, remove)
    fields = F.filter(F.split(F.trim("text"), r"\s+"), lambda t: t != "")
    n = F.size("_fields")
    error = F.when(n < 5, "too few fields").when((n - 5) % 3 != 0, "broken keypoint triplets").when(n != 5 + 3 * len(names), F.concat(F.lit("keypoints: "), ((n - 5) / 3).cast("int").cast("string")))
    kept = F.filter("_fields", lambda _, i: (i < 5) | ~F.floor((i - 5) / 3).isin(*drop))
    read = lines.withColumn("_fields", fields).withColumn("error", F.when(F.coalesce(n, F.lit(0)) > 0, error))
    bad = read.groupBy(F.col(path).alias("_path")).agg(F.bool_or(F.col("error").isNotNull()).alias("file_error"))  # pre-summed, so that a long file is many tasks' work
    met = read.join(bad, F.col(path).eqNullSafe(F.col("_path")))
    new = F.when(~F.col("file_error") & (n > 0), F.array_join(kept, " "))
    edited = met.withColumn("changed", F.coalesce(new != F.trim("text"), F.lit(False))).withColumn("text", F.coalesce(new, "text"))
    return edited.select(*lines.columns, "error", "file_error", "changed")


def edit_counts(edited: DataFrame, path: str = "path") -> DataFrame:
    """One row: files, files changed, lines changed and files left because of an error, as a preview of drop_from_files."""
    files = edited.groupBy(path).agg(F.bool_or("changed").alias("c"), F.bool_or("file_error").alias("e"), F.count_if("changed").alias("n"))
    return files.agg(F.count(F.lit(1)).alias("n_files"), F.count_if("c").alias("files_changed"), F.coalesce(F.sum("n"), F.lit(0)).alias("lines_changed"), F.count_if("e").alias("file_errors"))
