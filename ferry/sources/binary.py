"""Files with their bytes (attachments to upload), via Spark's ``binaryFile`` source."""

from __future__ import annotations

import os
import re
import stat
from collections.abc import Iterator
from fnmatch import translate
from itertools import islice

import pyarrow as pa
from pyarrow import NativeFile, fs
from pyspark.sql import DataFrame, SparkSession

from ferry.functions.text import file_name_of
from ferry.session import scratch_path
from ferry.sources.listing import local_folder


#: Scan partitions, of 32 files or fewer by Spark's cost of opening a file, that a task of a listing goes through.
LISTED_PARTITIONS = 128
#: Names of a listed folder that leave a task together.
LISTED_NAMES = 1 << 13


def read_files(spark: SparkSession, path: str, glob: str | None = None,
               recursive: bool = False, with_content: bool = True) -> DataFrame:
    """``(path, file_name, length, modification_time[, content])`` of the files at ``path``.

    Without ``with_content`` no file body is read (a listing). A folder on a mounted file system is then listed by
    tasks, once, at the call; other listings are Spark's, which keeps every file's status on the driver.
    """
    folder = None if with_content or recursive or not re.fullmatch(r"[\w.\- *?]*", glob or "") else local_folder(spark, path)
    if folder and (listed := list_folder(spark, folder, glob)) is not None:
        return listed.select("path", file_name_of("path").alias("file_name"), "length", "modification_time")
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(path)
    cols = ["path", file_name_of("path").alias("file_name"), "length",
            df["modificationTime"].alias("modification_time")]
    if with_content:
        return df.select(*cols, "content")
    # A listing opens no file: its tasks need not be as many as readers of bodies.
    return df.select(*cols).coalesce(max(1, -(-df.select("path").rdd.getNumPartitions() // LISTED_PARTITIONS)))


def open_file(path: str, seek: bool = False) -> NativeFile:
    """Open a file inside a task, on the store that its path names."""
    store, place = fs.FileSystem.from_uri("/" + path[5:].lstrip("/") if path.startswith("file:") else path)
    return store.open_input_file(place) if seek else store.open_input_stream(place, compression=None)


def is_hidden(name: str) -> bool:
    """Names that Spark's file sources pass over."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def has_partitions(entry: os.DirEntry) -> bool:
    """Whether the folder, or one below it, is named ``key=value``."""
    if "=" in entry.name:
        return True
    with os.scandir(entry.path) as entries:
        return any(has_partitions(e) for e in entries if not is_hidden(e.name) and e.is_dir())


def list_folder(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame | None:
    """``(path, length, modification_time)`` of the files right in a mounted folder, as Spark's file sources list them
    (empty ones left out); none where sub-folders are partitions, whose files Spark would add.

    One task streams the names, others look up length and time. The listing is written, so that neither the driver nor
    a task holds it and every later step sees the same one.
    """
    fits = re.compile(translate(glob or "*"))

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            with os.scandir(folder) as entries:
                shown = (e for e in entries if not is_hidden(e.name))
                found = (e.name for e in shown if (has_partitions(e) if e.is_dir() else fits.match(e.name)))
                while some := list(islice(found, LISTED_NAMES)):
                    yield pa.RecordBatch.from_pydict({"name": pa.array(some, pa.string())})

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, lengths, times = [], [], []
            for name in batch.column(0).to_pylist():
                try:
                    status = os.stat(f"{folder}/{name}")
                except FileNotFoundError:  # gone since, or a link to nothing
                    continue
                regular = stat.S_ISREG(status.st_mode)
                if regular and status.st_size or stat.S_ISDIR(status.st_mode):
                    paths.append(f"file:{folder}/{name}")
                    lengths.append(status.st_size if regular else None)
                    times.append(status.st_mtime_ns // 1_000_000 * 1000)
            yield pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string()), "length": pa.array(lengths, pa.int64()),
                                              "modification_time": pa.array(times, pa.timestamp("us", "UTC"))})

    path = scratch_path(spark, "listing")
    spark.range(0, 1, 1, 1).mapInArrow(names, "name string").repartition("name").mapInArrow(
        look_up, "path string, length long, modification_time timestamp").write.parquet(path)
    listed = spark.read.parquet(path)
    # A folder in the listing stands for partitions in it.
    return listed if listed.where("length is null").isEmpty() else None
