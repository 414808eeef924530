"""File trees and object stores as record sources.

Listing runs as Spark jobs over directories or key ranges (``listing``), so no single process holds the whole
listing.  ``inventory`` replaces it: a DataFrame of (key, size) such as the inventory report of an object store.

Reading is split by bytes, not by directory.  Contents are read twice only where it pays:
`fingerprints` hashes every file on the executors, block by block, and returns narrow rows, and `fetch` reads
the text of just the files that passed dedup, so texts are never shuffled.

A file that cannot be read becomes a row with an error.  So does the text of one that is too large for a
value; it has a hash all the same.  A directory that cannot be listed
fails the job: a listing cut short would look like deleted files.
"""

import hashlib
import os
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.functions.text import (
    DEFAULT_EXTENSIONS,
    allowed,
    in_hidden_dir,
    language_of,
    record_id,
    relative_key,
)
from chunkloom.sinks.scratch import remove
from chunkloom.sources.listing import FileStore, KeyStore, LocalStore, ObjectStore, Wanted, list_files

_BATCH_BYTES = 32 << 20  # content bytes per Arrow batch
_SPLIT_BYTES = 256 << 20  # content bytes per read task
_BLOCK_BYTES = 8 << 20  # bytes read and hashed at once
LARGEST = (1 << 31) - (1 << 20)  # a Spark value must stay below 2 GB


class _FileTooLarge(Exception):
    pass


def _blocks(file, size: int) -> Iterator[bytes]:
    step = max(1 << 16, min(_BLOCK_BYTES, size + 1))
    while block := file.read(step):
        yield block


def _digest(file, size: int) -> str:
    """The hash of a file of any size, one block in memory."""
    digest = hashlib.sha256()
    for block in _blocks(file, size):
        digest.update(block)
    return digest.hexdigest()


def _content(file, size: int, largest: int) -> bytes:
    parts, held = [], size if size > largest else 0
    for block in _blocks(file, size):
        held += len(block)
        if held > largest:
            raise _FileTooLarge(f"more than {largest} bytes")
        parts.append(block)
    return b"".join(parts)


def _read_files(store: FileStore, with_content: bool, largest: int):
    fields = [("key", pa.string()), ("content_hash", pa.string()), ("error", pa.string())]
    if with_content:
        fields.append(("bytes", pa.binary()))
    schema = pa.schema(fields)

    def one(open_file, key, size):
        try:
            with open_file(key) as file:
                if not with_content:
                    return None, _digest(file, size), None
                data = _content(file, size, largest)
            return data, hashlib.sha256(data).hexdigest(), None
        except Exception as e:
            return None, None, f"{type(e).__name__.lstrip('_')}: {e}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, open_file = store.open()
        rows, held = [], 0
        for batch in batches:
            keys, sizes = batch.column("key").to_pylist(), batch.column("size").to_pylist()
            for key, size in zip(keys, sizes, strict=True):
                size = size or 0  # an inventory may not know it
                if rows and held + size > _BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
                data, digest, error = one(open_file, key, size)
                row = {"key": key, "content_hash": digest, "error": error}
                if with_content:
                    row["bytes"] = data
                    held += len(data or b"")
                rows.append(row)
                if len(rows) == 10_000:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


class FileSource:
    """Files of one workspace.

    ``prefix`` is None for a directory tree, where hidden directories are skipped and paths
    are relative to the root.  For an object store it is a plain text prefix of the key.
    """

    name = "files"

    def __init__(
        self,
        spark: SparkSession,
        workspace_id: str,
        store: FileStore,
        *,
        extensions=None,
        prefix: str | None = None,
        metadata: Callable[[Column], dict[str, Column]] = lambda key: {},
        seq: int = 0,
        inventory: DataFrame | None = None,
        largest: int = LARGEST,
    ):
        self.spark = spark
        self.workspace_id = workspace_id
        self.store = store
        self.extensions = tuple(DEFAULT_EXTENSIONS if extensions is None else extensions)
        self.prefix = prefix
        self.metadata = metadata
        self.seq = seq
        self.inventory = inventory
        self.largest = largest
        self._entries = None
        self._listing = None

    def entries(self) -> DataFrame:
        """``(key, size)`` of the matching files, listed once."""
        if self._entries is None:
            found = self._list() if self.inventory is None else self.inventory
            self._entries = self._matching(found.select("key", "size"))
        return self._entries

    def _matching(self, files: DataFrame) -> DataFrame:
        key = F.col("key")
        files = files.where(allowed(key, self.extensions))
        if self.prefix is None:
            return files.where(~in_hidden_dir(key))
        return files.where(F.startswith(key, F.lit(self.prefix)))

    def _list(self) -> DataFrame:
        wanted = Wanted(self.prefix, frozenset(e.lower() for e in self.extensions))
        files, self._listing = list_files(self.spark, self.store, wanted)
        return files

    def _split(self, entries: DataFrame) -> DataFrame:
        """Spread the files over tasks by total size, independent of their directories."""
        least = self.spark.sparkContext.defaultParallelism
        total, count = entries.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
        tasks = max(min(least, count), total // _SPLIT_BYTES + 1, 1)
        return entries.repartition(int(tasks), "key")

    def _path(self) -> Column:
        if self.prefix is None:
            return F.col("key")
        return relative_key(F.col("key"), F.lit(self.prefix))

    def _read(self, entries: DataFrame, with_content: bool) -> DataFrame:
        schema = "key string, content_hash string, error string"
        if with_content:
            schema += ", bytes binary"
        read = self._split(entries).mapInArrow(_read_files(self.store, with_content, self.largest), schema)
        return read.select(
            F.lit(self.workspace_id).alias("workspace_id"),
            self._path().alias("path"),
            F.lit(self.seq).cast("long").alias("seq"),
            F.lit("upsert").alias("action"),
            *read.columns,
        )

    def workspaces(self) -> DataFrame:
        """The workspaces this source speaks for, also when it finds no file."""
        return self.spark.createDataFrame([(self.workspace_id,)], "workspace_id string")

    def fingerprints(self) -> DataFrame:
        """workspace_id, path, seq, action, content_hash, error, key of every file."""
        return self._read(self.entries(), with_content=False)

    def fetch(self, keys: DataFrame) -> DataFrame:
        """Records with text for the given fingerprint rows (deletes excluded)."""
        wanted = self.entries().join(keys.select("key"), "key", "left_semi")
        read = self._read(wanted, with_content=True)
        meta = self.metadata(F.col("key"))
        pairs = [x for name, value in meta.items() for x in (F.lit(name), value)]
        return read.select(
            record_id(F.col("workspace_id"), F.col("path")).alias("id"),
            "workspace_id",
            "path",
            F.lit("").alias("symbol"),
            F.lit("").alias("symbol_type"),
            language_of(F.col("key")).alias("language"),
            # A cast keeps bytes that are no UTF-8.
            F.coalesce(F.col("bytes").cast("string"), F.lit("")).alias("content"),
            "content_hash",
            F.lit(None).cast("array<float>").alias("embedding"),
            F.create_map(*pairs).cast("map<string,string>").alias("metadata"),
            "action",
            "seq",
            "error",
        )

    def close(self) -> None:
        """Forget the listing."""
        if self._listing is not None:
            remove(self.spark, self._listing)
        self._entries = self._listing = None


def local_source(spark, workspace_id: str, root: str, extensions=None, seq: int = 0):
    if not os.path.isdir(root):
        raise NotADirectoryError(f"cannot scan {root!r}: no such folder")
    return FileSource(spark, workspace_id, LocalStore(root), extensions=extensions, seq=seq)


def _bucket(name: str, make_filesystem, make_pages) -> FileStore:
    return KeyStore(name, make_filesystem, make_pages) if make_pages else ObjectStore(name, make_filesystem)


def s3_source(
    spark, workspace_id: str, bucket: str, prefix: str = "", extensions=None, seq: int = 0,
    make_filesystem=None, inventory: DataFrame | None = None, make_pages=None,
):
    """Objects of a bucket; credentials come from the default chain of each executor.

    ``make_pages`` (``listing.s3_pages(bucket)`` where the S3 client is installed) lists by prefix and key range.
    """

    def default():
        from pyarrow.fs import S3FileSystem

        return S3FileSystem()

    return FileSource(
        spark,
        workspace_id,
        _bucket(bucket, make_filesystem or default, make_pages),
        extensions=extensions,
        prefix=prefix,
        metadata=lambda key: {"s3_key": key, "bucket": F.lit(bucket)},
        seq=seq,
        inventory=inventory,
    )


def azure_source(
    spark, workspace_id: str, account_name: str, account_key: str, container: str,
    prefix: str = "", extensions=None, seq: int = 0, make_filesystem=None,
    inventory: DataFrame | None = None, account_url: str = "", make_pages=None,
):
    """Blobs of a container; ``account_url`` names an endpoint other than the public one."""
    place = urlsplit(account_url)
    endpoint = {"blob_storage_authority": place.netloc, "blob_storage_scheme": place.scheme} if place.netloc else {}

    def default():
        from pyarrow.fs import AzureFileSystem

        return AzureFileSystem(account_name=account_name, account_key=account_key, **endpoint)

    return FileSource(
        spark,
        workspace_id,
        _bucket(container, make_filesystem or default, make_pages),
        extensions=extensions,
        prefix=prefix,
        metadata=lambda key: {"blob_name": key, "container": F.lit(container)},
        seq=seq,
        inventory=inventory,
    )
