"""Files by the session's Hadoop file systems, so that paths mean here what they mean to Spark."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from threading import Lock
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from starloom.session import shared_dir

#: Files that a task keeps open at a time; one with rows for more folders sorts the rest of them.
WRITERS = 8
_HERE = Lock()
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_DROPPED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing: dict[str, int] = {}


def _at(spark: SparkSession, path: str):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def exists(spark: SparkSession, path: str) -> bool:
    fs, there = _at(spark, path)
    return fs.exists(there)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, there = _at(spark, path)
    fs.mkdirs(there)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or a whole folder; True if it was there."""
    fs, there = _at(spark, path)
    return fs.delete(there, True)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that fit a pattern, in order of their names."""
    fs, there = _at(spark, pattern)
    return sorted(status.getPath().toString() for status in fs.globStatus(there) or ())


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; its new parent is made if need be."""
    fs, there = _at(spark, target)
    fs.mkdirs(there.getParent())
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(source), there):
        raise OSError(f"cannot move to {target}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, there = _at(spark, path)
    stream = fs.open(there)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """A new file, there as a whole or not at all; False if there is one of this name already."""
    fs, there = _at(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{there.getParent().toString()}/.draft-{uuid4().hex}")
    stream = fs.create(draft, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    try:
        # Without the option to overwrite, a file that is there already is an error.
        context.rename(fs.makeQualified(draft), fs.makeQualified(there), spark.sparkContext._gateway.new_array(kind, 0))
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if "FileAlreadyExists" in error.java_exception.toString():
            return False
        raise
    return True


@contextmanager
def shelf(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A function that computes a result once and keeps it in the shared folder until this ends.

    A checkpoint would keep it until the driver happens to collect its garbage, in several times the bytes
    and in as many parts as it was shuffled into.
    """
    folder = f"{shared_dir(spark)}/kept-{uuid4().hex}"

    def keep(df: DataFrame) -> DataFrame:
        path = f"{folder}/{uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield keep
    finally:
        remove(spark, folder)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What queries within this shuffle goes when each has ended, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_DROPPED)
    spark.conf.set(_DROPPED, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROPPED, before)


@contextmanager
def open_files(spark: SparkSession) -> Iterator[None]:
    """Writes into folders within this put rows out as they come, in place of sorting each task's rows by folder first.

    Such a sort holds all rows of the task, and a task is sized by what is shuffled: a million narrow
    rows with few values take 3 MB there and 100 MB in a sort.
    """
    session = spark._jsparkSession.sessionUUID()
    with _HERE:
        # Set by the first of several threads, taken back by the last; a setting of the user's stays.
        if _writing.get(session) or int(spark.conf.get(_WRITERS, "0")) <= 0:
            _writing[session] = _writing.get(session, 0) + 1
            spark.conf.set(_WRITERS, str(WRITERS))
            mine = True
        else:
            mine = False
    try:
        yield
    finally:
        if mine:
            with _HERE:
                _writing[session] -= 1
                if not _writing[session]:
                    del _writing[session]
                    spark.conf.unset(_WRITERS)
