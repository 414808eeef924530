"""Listing of trees and of flat key spaces by units that tasks hand on.

A unit is one call's worth of listing: a directory, or a range of keys. A task works its units off breadth first
and after a number of calls hands those it has left to the next round, which spreads them anew. So a subtree or a
prefix that holds a third of all keys is shared by all tasks, deep trees take few rounds, and nothing is planned from one
place. (A Python data source would fix its partitions before it has seen the sizes of subtrees.)

Prefix and extensions go with the listing: other keys leave neither the store, where it can select by prefix, nor the task.
"""

import json
import os
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from chunkloom.sinks.scratch import new_dir

LISTED = "is_unit boolean, key string, size long"
_SCHEMA = pa.schema([("is_unit", pa.bool_()), ("key", pa.string()), ("size", pa.int64())])
_FIRST_CALLS, _CALLS = 32, 256  # listing calls of a task in the first round, and in later ones
_LAST = "\U0010ffff"

Found = Iterable[tuple[bool, str, int]]  # (is a unit, key or unit, size)
Page = Callable[[str, str], tuple[list[tuple[str, int]], bool]]


@dataclass(frozen=True)
class Wanted:
    """What a listing is for. Without a prefix it is a tree, whose hidden directories are skipped."""

    prefix: str | None
    extensions: frozenset[str]

    def file(self, key: str) -> bool:
        """False only for keys that are surely not wanted; letters beyond ASCII are left to Spark's lower case."""
        if self.prefix is not None and not key.startswith(self.prefix):
            return False
        _, dot, last = key.rpartition("/")[2].rpartition(".")
        ext = (dot + last).lower() if dot else ""
        return ext in self.extensions or not ext.isascii()

    def folder(self, key: str) -> bool:
        """May wanted keys lie in this directory?"""
        if self.prefix is None:
            name = key.rpartition("/")[2]
            return not name.startswith(".") or name == "."
        return f"{key}/".startswith(self.prefix) or self.prefix.startswith(f"{key}/")


class FileStore:
    """How tasks list and open files; shipped to the executors. This form lists directory by directory."""

    def open(self) -> tuple[Callable, Callable]:
        """``entries(directory)`` giving (is_dir, key, size), and ``open_file(key)`` giving a binary file."""
        raise NotImplementedError

    def units(self, wanted: Wanted) -> list[str]:
        """Where the listing begins: the deepest directory that holds all wanted keys."""
        return ["" if wanted.prefix is None else wanted.prefix.rpartition("/")[0]]

    def step(self, entries: Callable, unit: str, wanted: Wanted) -> Found:
        for is_dir, key, size in entries(unit):
            if wanted.folder(key) if is_dir else wanted.file(key):
                yield is_dir, key, size


class LocalStore(FileStore):
    """A directory every executor can see.  Links to directories are not followed."""

    def __init__(self, root: str):
        self.root = root

    def open(self):
        def entries(key):
            with os.scandir(os.path.join(self.root, key)) as found:
                for e in found:
                    is_dir = e.is_dir(follow_symlinks=False)
                    size = 0 if is_dir else e.stat(follow_symlinks=False).st_size
                    yield is_dir, os.path.join(key, e.name), size

        return entries, lambda key: open(os.path.join(self.root, key), "rb")


class ObjectStore(FileStore):
    """A bucket or container behind a ``pyarrow.fs`` file system made inside each task."""

    def __init__(self, bucket: str, make_filesystem: Callable):
        self.bucket = bucket
        self.make_filesystem = make_filesystem

    def _opener(self) -> tuple:
        fs = self.make_filesystem()
        return fs, lambda key: fs.open_input_stream(f"{self.bucket}/{key}", compression=None)

    def open(self):
        from pyarrow.fs import FileSelector, FileType

        fs, open_file = self._opener()
        skip = len(self.bucket) + 1

        def entries(key):
            for info in fs.get_file_info(FileSelector(f"{self.bucket}/{key}".rstrip("/"))):
                yield info.type == FileType.Directory, info.path[skip:], info.size or 0

        return entries, open_file


class KeyStore(ObjectStore):
    """A bucket that is listed by key ranges, whatever its keys look like.

    ``make_pages`` makes, inside each task, ``page(prefix, after)``: the next keys with the prefix that come after a
    key, ascending by code point, with their sizes, and whether there are more. What remains
    after a page is halved, and the halves are listed apart.
    """

    def __init__(self, bucket: str, make_filesystem: Callable, make_pages: Callable[[], Page]):
        super().__init__(bucket, make_filesystem)
        self.make_pages = make_pages

    def open(self):
        return self.make_pages(), self._opener()[1]

    def units(self, wanted):
        return [json.dumps(["", None])]

    def step(self, page, unit, wanted):
        after, until = json.loads(unit)
        prefix = wanted.prefix or ""
        found, more = page(prefix, after)
        for key, size in found:
            if until is not None and key > until:
                return
            if wanted.file(key):
                yield False, key, size
        if more and found:
            last = found[-1][0]
            if last == until:
                return
            half = middle(last, prefix + _LAST if until is None else until)
            for part in [[last, until]] if half is None else [[last, half], [half, until]]:
                yield True, json.dumps(part), 0


def middle(low: str, high: str) -> str | None:
    """A text between two others, about halfway if keys are printable ASCII; None if there is none near by."""
    if not low < high:
        return None
    same = len(os.path.commonprefix([low, high]))
    x = ord(low[same]) if same < len(low) else 31
    y = ord(high[same])
    if x < 127:
        y = min(y, 127)
    half = (x + y) // 2
    if 0xD800 <= half <= 0xDFFF:  # no characters
        half = 0xD7FF
    if x < half < y:
        return low[:same] + chr(half)
    if same == len(low):
        return None
    # the characters are neighbours: halve what follows low's
    for i in range(same + 1, len(low) + 1):
        x = ord(low[i]) if i < len(low) else 31
        if x < 126:
            return low[:i] + chr((x + 127) // 2)
    return None


def s3_pages(bucket: str) -> Callable[[], Page]:
    """Pages of an S3 bucket by its own client, where that is installed."""

    def make() -> Page:
        import boto3

        client = boto3.client("s3")

        def page(prefix, after):
            got = client.list_objects_v2(Bucket=bucket, Prefix=prefix, StartAfter=after)
            return [(o["Key"], o["Size"]) for o in got.get("Contents", [])], got["IsTruncated"]

        return page

    return make


def _walk(store: FileStore, wanted: Wanted, calls: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lister, _ = store.open()
        units = deque(key for batch in batches for key in batch.column("key").to_pylist())
        rows = []
        for _ in range(calls):
            if not units:
                break
            for is_unit, key, size in store.step(lister, units.popleft(), wanted):
                if is_unit:
                    units.append(key)
                    continue
                rows.append((False, key, size))
                if len(rows) == 10_000:
                    yield _batch(rows)
                    rows = []
        rows += [(True, unit, 0) for unit in units]
        if rows:
            yield _batch(rows)

    return run


def _batch(rows) -> pa.RecordBatch:
    columns = [pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _SCHEMA, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)


def list_files(
    spark: SparkSession, store: FileStore, wanted: Wanted, first: int = _FIRST_CALLS, calls: int = _CALLS
) -> tuple[DataFrame, str]:
    """``(key, size)`` of the wanted files, and the folder in which the listing is staged.

    A unit that cannot be listed fails the job: a listing cut short would look like deleted files.
    """
    base = new_dir(spark, "listing")
    tasks = spark.sparkContext.defaultParallelism * 4
    frontier = spark.createDataFrame([(unit,) for unit in store.units(wanted)], "key string")
    level = 0
    while True:
        path = f"{base}/level={level}"
        frontier.mapInArrow(_walk(store, wanted, first if level == 0 else calls), LISTED).write.parquet(path)
        left = spark.read.schema(LISTED).parquet(path).where("is_unit").select("key")
        if left.isEmpty():
            break
        frontier = left.repartition(tasks)
        level += 1
    files = spark.read.schema(f"{LISTED}, level int").parquet(base).where("NOT is_unit")
    return files.select("key", "size"), base
