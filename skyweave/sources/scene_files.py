"""One text file per scene, written by the tasks that hold its lines."""

from __future__ import annotations

import os
import re
import zlib
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

# Characters that Spark's own writer escapes in names, the name of no scene, and the folders that share the files, as listing takes a task a folder.
UNSAFE = re.compile(r"[\x00-\x1f\x7f\"#%'*/:=?\\{\[\]^]")
NO_SCENE = "__HIVE_DEFAULT_PARTITION__"
FOLDERS = 256


def write_by_scene(lines: DataFrame, order: list[str], path: str) -> None:
    """One file per scene (unique_scene, value), its lines in order; the rows are sorted, not gathered, so that a scene of any size takes bounded memory. On a
    local file system tasks write the files themselves, named by scene, as Hadoop's writer starts several processes a file there to set permissions;
    a file gets its name once it is whole, so that reruns of a task leave the same files. Elsewhere each scene has a folder."""
    dealt = lines.repartition("unique_scene").sortWithinPartitions("unique_scene", *order).select("unique_scene", "value")
    folder = _local(lines.sparkSession, path)
    if folder is None:
        dealt.write.partitionBy("unique_scene").text(path)
        return
    os.makedirs(folder)
    dealt.mapInArrow(_filer(folder), "files bigint").write.format("noop").mode("overwrite").save()


def _local(spark: SparkSession, path: str) -> str | None:
    """The path on the local file system, or None where it lies on another one."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(path).toUri().getPath() if system.getUri().toString() == "file:///" else None


def _filer(folder: str):
    """For mapInArrow over (unique_scene, value) sorted by scene: writes each scene's file, and gives their number."""

    def place(scene: str | None) -> tuple[str, str]:
        name = UNSAFE.sub(lambda c: f"%{ord(c[0]):02X}", scene) if scene else NO_SCENE
        return f"{folder}/files={zlib.crc32(name.encode()) % FOLDERS:03d}", f"{name}.txt"  # a form that every reader of Spark looks into

    def over(batches):
        scene, out, made, n = None, None, set(), 0

        def start() -> None:
            nonlocal out
            at = place(scene)[0]
            if at not in made:
                os.makedirs(at, exist_ok=True)
                made.add(at)
            out = open(f"{at}/.{TaskContext.get().taskAttemptId()}", "w", encoding="utf-8", newline="\n")  # noqa: SIM115 (open over batches)

        def finish() -> None:
            out.close()
            os.replace(out.name, "/".join(place(scene)))

        try:
            for batch in batches:
                for found, rows in groupby(zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True), itemgetter(0)):
                    found = found or None
                    if out is None or found != scene:
                        if out is not None:
                            finish()
                        scene, n = found, n + 1
                        start()
                    out.writelines(f"{'' if v is None else v}\n" for _, v in rows)
            if out is not None:
                finish()
        finally:
            if out is not None:
                out.close()
        yield pa.RecordBatch.from_pydict({"files": pa.array([n], pa.int64())})

    return over
