"""Shared scratch folders for derived files, and small file-system lookups."""

from __future__ import annotations

import re
from collections.abc import Iterator
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_issued: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    A local session that leaves the setting unset uses its warehouse folder; its executors are the
    driver.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the scratch root that no other call returns."""
    path = f"{scratch_root(spark)}/lakeloom/{label}-{uuid4().hex}"
    _issued.append(path)
    return path


def scratch_mark() -> int:
    """Where the list of scratch paths stands, for :func:`release_scratch`."""
    return len(_issued)


def release_scratch(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> None:
    """Delete what was written below the scratch paths of this process, those given out after ``since`` only.

    Frames are lazy, so this is for the end of a job or of a step of it whose result is written, when all that read from
    there are done. Paths that start with one of ``keep`` stay.
    """
    kept = [path for path in _issued[since:] if path.startswith(tuple(keep))]
    for path in _issued[since:]:
        if path not in kept:
            delete_folder(spark, path)
    _issued[since:] = kept


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return hadoop_path.getFileSystem(conf), hadoop_path


def glob_paths(spark: SparkSession, pattern: str, folders_only: bool = False) -> list[str]:
    """Paths that match a Hadoop glob, on any file system Spark can read."""
    fs, path = _file_system(spark, pattern)
    found = fs.globStatus(path) or []
    return sorted(s.getPath().toString() for s in found if s.isDirectory() or not folders_only)


def first_folder(spark: SparkSession, path: str, named: str = "") -> str | None:
    """One folder right below ``path`` whose name holds ``named``, hidden ones left out.

    The listing is read entry by entry up to the first match, and ``path`` is taken as it is, not as
    a pattern.
    """
    fs, folder = _file_system(spark, path)
    if not fs.exists(folder):
        return None
    entries = fs.listStatusIterator(folder)
    while entries.hasNext():
        entry = entries.next()
        name = entry.getPath().getName()
        if entry.isDirectory() and named in name and name[0] not in "_.":
            return entry.getPath().toString()
    return None


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, place = _file_system(spark, path)
    return bool(fs.exists(place))


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Folders right below ``path``, hidden ones left out; ``path`` is no pattern."""
    fs, folder = _file_system(spark, path)
    found = [status.getPath() for status in fs.listStatus(folder) if status.isDirectory()]
    return sorted(p.toString() for p in found if p.getName()[0] not in "_.")


def direct_files(spark: SparkSession, path: str) -> Iterator[str]:
    """Files right below ``path``, hidden ones left out, read entry by entry."""
    fs, folder = _file_system(spark, path)
    entries = fs.listStatusIterator(folder)
    while entries.hasNext():
        entry = entries.next()
        if entry.isFile() and entry.getPath().getName()[0] not in "_.":
            yield entry.getPath().toString()


def as_given(path: str) -> str:
    """The path with pattern characters escaped, for readers that take patterns."""
    return re.sub(r"([\\*?\[\]{},])", r"\\\1", path)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a path; 0 where there is none."""
    fs, folder = _file_system(spark, path)
    return fs.getContentSummary(folder).getLength() if fs.exists(folder) else 0


def create_mark(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless it is there; tells whether this call made it."""
    fs, file = _file_system(spark, path)
    try:
        return bool(fs.createNewFile(file))
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception):
            return False
        raise


def write_text_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a short file as a whole, over what was there."""
    fs, file = _file_system(spark, path)
    stream = fs.create(file, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text_file(spark: SparkSession, path: str) -> str:
    """The text of a short file; empty where there is none."""
    fs, file = _file_system(spark, path)
    if not fs.exists(file):
        return ""
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def set_file_times(spark: SparkSession, path: str, millis: int) -> None:
    """Set the modification time of the files right below a path."""
    fs, folder = _file_system(spark, path)
    for status in fs.listStatus(folder):
        if status.isFile():
            fs.setTimes(status.getPath(), millis, -1)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it; one that is not there is no error."""
    fs, folder = _file_system(spark, path)
    fs.delete(folder, True)
