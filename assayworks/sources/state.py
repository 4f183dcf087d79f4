"""What a product's folders say about themselves: their one true path, their generation, and numbered marks.

A mark is an empty file whose name is its number, in a folder of the root. Numbers only grow, so the greatest one tells
how far something has come, whatever name the root is called by, and nothing else has to be read.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Marks: batches of orders that were begun, attempts to add batches to the totals, and batches that the totals hold.
BATCHES, ATTEMPTS, APPLIED = "batches", "attempts", "applied"
GENERATION = "generation="


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def qualified_root(spark: SparkSession, root: str) -> str:
    """The root with its scheme and without trailing or double slashes, so that every spelling is the same root."""
    files, at = _folder(spark, root)
    return files.makeQualified(at).toString().rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _folder(spark, path)
    return files.exists(at)


def _numbers(spark: SparkSession, path: str, prefix: str = "") -> list[int]:
    files, at = _folder(spark, path)
    names = [status.getPath().getName() for status in files.listStatus(at)] if files.exists(at) else []
    found = [n.removeprefix(prefix) for n in names if n.startswith(prefix)]
    return sorted(int(n) for n in found if n.isdigit())


def marks(spark: SparkSession, root: str, kind: str) -> list[int]:
    return _numbers(spark, f"{root}/_state/{kind}")


def greatest(spark: SparkSession, root: str, kind: str) -> int:
    return max(marks(spark, root, kind), default=0)


def put_mark(spark: SparkSession, root: str, kind: str, number: int) -> None:
    """Adds a mark and then removes smaller ones, so that a folder holds a few."""
    files, at = _folder(spark, f"{root}/_state/{kind}/{number}")
    before = marks(spark, root, kind)
    files.create(at, True).close()
    for old in before:
        if old < number:
            files.delete(_folder(spark, f"{root}/_state/{kind}/{old}")[1], False)


def next_batch(spark: SparkSession, root: str) -> int:
    """Registers the number of a new batch, before any row can carry it. One run of a product at a time."""
    number = greatest(spark, root, BATCHES) + 1
    put_mark(spark, root, BATCHES, number)
    return number


def active_root(spark: SparkSession, root: str) -> str:
    """The folder of the newest generation; the root itself as long as there was no full refresh."""
    whole = qualified_root(spark, root)
    newest = max(_numbers(spark, whole, GENERATION), default=0)
    return f"{whole}/{GENERATION}{newest}" if newest else whole


def new_generation(spark: SparkSession, root: str) -> str:
    """Begins a full refresh: empty folders for tables, checkpoints and state. Older generations stay for their readers."""
    whole = qualified_root(spark, root)
    path = f"{whole}/{GENERATION}{max(_numbers(spark, whole, GENERATION), default=0) + 1}"
    files, at = _folder(spark, path)
    files.mkdirs(at)
    return path
