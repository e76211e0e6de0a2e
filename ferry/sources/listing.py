"""Folder listings through Hadoop's file system API: any store Spark reads, and no Spark job.

Only names of folders, and of the first file of a folder, reach Python; sorting and matching of a
folder's files is done by the file system client.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def local_folder(spark: SparkSession, path: str) -> str | None:
    """The absolute place of a folder on a mounted file system; none for other stores, patterns and files."""
    if set(path) & set("{}[]*?\\"):
        return None
    fs, p = _open(spark, path)
    if fs.getUri().getScheme() != "file" or not fs.exists(p) or not fs.getFileStatus(p).isDirectory():
        return None
    return fs.makeQualified(p).toUri().getPath().rstrip("/")


def create_empty(spark: SparkSession, path: str) -> None:
    """An empty file, such as a success marker."""
    fs, p = _open(spark, path)
    fs.create(p, True).close()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this job has written, and the folder above it if that is left empty."""
    fs, p = _open(spark, path)
    fs.delete(p, True)
    if not fs.listStatus(p.getParent()):
        fs.delete(p.getParent(), False)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, sorted; hidden ones (``_``, ``.``) left out."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n for n in names if n[0] not in "_.")


def first_file(spark: SparkSession, folder: str, glob: str) -> str | None:
    """The first non-empty file of ``folder`` (not below it) that matches, in name order."""
    fs, _ = _open(spark, folder)
    jvm = spark.sparkContext._jvm
    for status in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{glob}")) or ():
        if status.isFile() and status.getLen() > 0 and status.getPath().getName()[0] not in "_.":
            return status.getPath().toString()
    return None


def first_file_below(spark: SparkSession, folder: str, glob: str) -> str | None:
    """The first matching file of ``folder``, else of its sub-folders in name order, at any depth."""
    found = first_file(spark, folder, glob)
    if found:
        return found
    for name in child_folders(spark, folder):
        found = first_file_below(spark, f"{folder.rstrip('/')}/{name}", glob)
        if found:
            return found
    return None


def folders_with(spark: SparkSession, root: str, glob: str) -> list[tuple[str, str]]:
    """(folder, its first matching file) for ``root`` and every folder below it that has one."""
    first = first_file(spark, root, glob)
    out = [(root.rstrip("/"), first)] if first else []
    for name in child_folders(spark, root):
        out += folders_with(spark, f"{root.rstrip('/')}/{name}", glob)
    return out
