"""The registered queries: one per operator, each over whole given tables."""

import math
import os

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.functions.text import (
    allowed,
    hash_content,
    in_hidden_dir,
    language_of,
    metadata_json,
    record_id,
    relative_key,
)
from chunkloom.operators import dedup, embed, outcome, replay, snapshot
from chunkloom.operators.fanout import fan_out, symbol_collisions
from chunkloom.operators.go_symbols import go_chunks
from chunkloom.operators.jobs import job_rollup
from chunkloom.operators.markdown import markdown_chunks
from chunkloom.operators.python_symbols import python_chunks
from chunkloom.plans import views
from chunkloom.plans.flow import Flow
from chunkloom.sinks.scratch import Scratch, new_dir
from chunkloom.sinks.tables import ChunkTable, MemoryTable, PointTable, SnapshotTable, VersionTable
from chunkloom.sinks.versions import TableSet, Writer
from chunkloom.sources.files import local_source
from chunkloom.sources.tables import TableSource
from chunkloom.streaming.dedup import dedup_stream
from chunkloom.streaming.replay import replay_stream

DIM = 64
BLOCK = 2_500  # sequence numbers per block: several blocks even on the small tables
HOT_BLOCK = 100  # rows per block of a hot path
TOO_LONG = 300
LANGUAGE_SAMPLES = [
    ".go", ".py", ".md", ".MDX", ".ts", ".tsx", ".js", ".jsx", ".rs", ".java", ".cpp", ".cc",
    ".cxx", ".c", ".h", ".hpp", ".txt", "",
]


def vector_text(vector) -> F.Column:
    """A vector as text, in millionths."""
    millionths = F.transform(
        vector, lambda v: F.floor(v.cast("double") * 1e6 + 0.5).cast("string")
    )
    return F.array_join(millionths, ",")


# --- scans -----------------------------------------------------------------------------


def _tree(spark: SparkSession, sf_dir: str) -> str:
    """Write every document as a file below the shared scratch folder."""
    root = new_dir(spark, "tree").removeprefix("file:")
    n = F.col("doc_id")
    folder = F.when(n % 11 == 0, F.concat("source", F.lit("/.git"))).otherwise(F.col("source"))
    name = F.concat(n.cast("string"), views.ext_of(n, views.EXTENSIONS))
    name = F.concat(F.when(n % 5 == 0, "__d").when(n % 5 == 1, ".d").otherwise("d"), name)
    files = views.spread(views.table(spark, sf_dir, "documents")).select(
        F.concat_ws("/", folder, name).alias("path"), "text"
    )

    def write(batches):
        for batch in batches:
            for path, text in zip(batch["path"], batch["text"], strict=True):
                full = os.path.join(root, path)
                os.makedirs(os.path.dirname(full), exist_ok=True)
                with open(full, "wb") as f:
                    f.write(text.encode())
            yield pd.DataFrame({"n": [len(batch)]})

    files.mapInPandas(write, "n long").agg(F.sum("n")).first()
    return root


def record_scan(spark, sf_dir):
    source = local_source(spark, "tree", _tree(spark, sf_dir))
    found = source.fingerprints().where("error IS NULL")
    return source.fetch(found).select(
        "id", "workspace_id", "path", "language", "content_hash", "action",
        F.length("content").alias("n_chars"),
        (hash_content(F.col("content")) == F.col("content_hash")).alias("same_hash"),
    )


def relative_path(spark, sf_dir):
    return views.object_keys(spark, sf_dir).select(
        "page_id", "key", "prefix", relative_key(F.col("key"), F.col("prefix")).alias("path")
    )


def _doc_paths(spark, sf_dir, extensions):
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "source")
    ext = views.ext_of(F.col("doc_id"), extensions)
    return docs.withColumn("path", F.concat(F.lit("f"), F.col("doc_id").cast("string"), ext))


def ext_filter(spark, sf_dir):
    return (
        _doc_paths(spark, sf_dir, views.EXTENSIONS).where(allowed(F.col("path"))).select("path")
    )


def hidden_prune(spark, sf_dir):
    folders = ["a/", ".git/", "a/.b/", "_p/", ".", "a/.", ""]
    docs = _doc_paths(spark, sf_dir, views.EXTENSIONS)
    path = F.concat(views.ext_of(F.col("doc_id"), folders), "path")
    return docs.select(path.alias("path")).where(~in_hidden_dir(F.col("path")))


def language_tag(spark, sf_dir):
    docs = _doc_paths(spark, sf_dir, LANGUAGE_SAMPLES)
    return docs.select("path", language_of(F.col("path")).alias("language"))


def record_id_query(spark, sf_dir):
    docs = _doc_paths(spark, sf_dir, views.EXTENSIONS)
    return docs.select("path", record_id(F.col("source"), F.col("path")).alias("id"))


def origin_metadata(spark, sf_dir):
    n = F.col("page_id") % 3
    s3 = F.create_map(F.lit("s3_key"), F.col("key"), F.lit("bucket"), F.lit("b1"))
    blob = F.create_map(F.lit("blob_name"), F.col("key"), F.lit("container"), F.lit("c1"))
    origin = F.when(n == 0, s3).when(n == 1, blob)
    return views.object_keys(spark, sf_dir).select(
        "page_id", metadata_json(origin).alias("metadata")
    )


# --- dedup and snapshot ----------------------------------------------------------------


def content_hash(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents")
    return docs.select("doc_id", hash_content(F.col("text")).alias("content_hash"))


def _plain(spark, sf_dir):
    return views.records(spark, sf_dir, content=lambda text: text)


def dedup_snapshot(spark, sf_dir):
    recs = _plain(spark, sf_dir)
    files = recs.select("workspace_id", "path", "action", "content_hash")
    return dedup.changed_files(files, views.old_snapshot(recs)).select(
        "workspace_id", "path", "content_hash"
    )


def dedup_sequence(spark, sf_dir):
    log = views.change_log(spark, sf_dir).where("action <> 'delete'")
    return dedup.drop_unchanged(log, seq_block=BLOCK).select("path", "seq", "content_hash")


def dedup_sequence_hot(spark, sf_dir):
    """Half of the log is one path, and numbers are a clock's: cut by quantiles."""
    log = views.clocked_log(spark, sf_dir)
    narrow = log.select("workspace_id", "path", "seq", "action", "content_hash")
    scratch = Scratch(spark)
    hot = scratch.staged(dedup.hot_paths(narrow, HOT_BLOCK), "hot")
    cuts = scratch.staged(dedup.hot_cuts(narrow, hot, HOT_BLOCK), "cuts")
    return dedup.drop_unchanged(narrow, hot=cuts, seq_block=HOT_BLOCK).select("path", "seq", "content_hash")


def dedup_with_deletes(spark, sf_dir):
    return dedup.drop_unchanged(
        views.change_log(spark, sf_dir), views.event_snapshot(spark, sf_dir), seq_block=BLOCK
    ).select("path", "seq", "action")


def dedup_with_deletes_strict(spark, sf_dir):
    return dedup.drop_unchanged(
        views.change_log(spark, sf_dir),
        views.event_snapshot(spark, sf_dir),
        deletes_reset=False,
        seq_block=BLOCK,
    ).select("path", "seq", "action")


def snapshot_load(spark, sf_dir):
    return snapshot.load_snapshot(views.old_snapshot(_plain(spark, sf_dir)), "src3")


def snapshot_upsert(spark, sf_dir):
    recs = _plain(spark, sf_dir)
    merged = snapshot.upsert_snapshot(views.old_snapshot(recs), recs, views.NOW)
    return merged.withColumn("updated_at", F.col("updated_at").cast("string"))


def snapshot_delete(spark, sf_dir):
    recs = _plain(spark, sf_dir)
    gone = recs.where("seq % 3 = 0")
    return snapshot.delete_from_snapshot(views.old_snapshot(recs), gone).select(
        "workspace_id", "path", "content_hash"
    )


def tombstones(spark, sf_dir):
    recs = _plain(spark, sf_dir)
    return snapshot.tombstones(views.old_snapshot(recs), recs)


# --- fan-out ---------------------------------------------------------------------------


def _chunk_table(recs: DataFrame, chunker) -> DataFrame:
    rows = recs.select("path", F.posexplode(chunker(F.col("content"))).alias("chunk_no", "c"))
    return rows.select("path", "chunk_no", "c.symbol", "c.symbol_type", "c.content")


def markdown_sections(spark, sf_dir):
    recs = views.records(spark, sf_dir, views.md_content, [".md"])
    return _chunk_table(recs, markdown_chunks)


def go_symbols(spark, sf_dir):
    recs = views.records(spark, sf_dir, views.go_content, [".go"])
    return _chunk_table(recs, go_chunks)


def python_symbols(spark, sf_dir):
    recs = views.records(spark, sf_dir, views.py_content, [".py"])
    return _chunk_table(recs, python_chunks)


def fanout_mixed(spark, sf_dir):
    recs = views.records(spark, sf_dir).withColumn(
        "action", F.when(F.col("seq") % 10 == 9, "delete").otherwise("upsert")
    )
    return fan_out(recs).select(
        "path", "chunk_no", "id", "symbol", "symbol_type", "language", "content_hash", "action"
    )


def whole_file_fallback(spark, sf_dir):
    """Texts without any declaration or section."""
    exts = [".go", ".py", ".md"]
    recs = views.records(spark, sf_dir, lambda text: text, exts)
    headings = F.concat(F.lit("#"), F.replace("content", F.lit("\n"), F.lit("\n#")))
    imports = F.concat(
        F.lit("package p\n\nimport \"x\"\n// "),
        F.replace("content", F.lit("\n"), F.lit("\n// ")),
    )
    even = F.col("seq") % 2 == 0
    shaped = (
        F.when((F.col("language") == "markdown") & even, headings)
        .when((F.col("language") == "go") & even, imports)
        .otherwise(F.col("content"))
    )
    recs = recs.withColumn("content", shaped)
    return (
        fan_out(recs)
        .where("origin = 'whole'")
        .select("id", "path", "symbol", "symbol_type", "content_hash")
    )


def chunk_identity(spark, sf_dir):
    recs = views.records(spark, sf_dir, views.md_content, [".md"])
    recs = recs.withColumn("metadata", F.when(F.col("seq") % 2 == 0, F.col("metadata")))
    return fan_out(recs).select(
        "file_id", "id", "chunk_no", "symbol", "language", "content_hash", "action",
        metadata_json(F.col("metadata")).alias("metadata"),
        F.col("embedding").isNull().alias("no_vector"),
    )


def symbol_collisions_query(spark, sf_dir):
    recs = views.records(spark, sf_dir, views.md_numbered, [".md"])
    return symbol_collisions(fan_out(recs))


# --- tables ----------------------------------------------------------------------------


def _chunk_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "workspace_id", "path", "symbol", "content", "content_hash", "metadata",
        vector_text(F.col("embedding")).alias("vector"),
        F.col("created_at").cast("string").alias("created_at"),
        F.col("updated_at").cast("string").alias("updated_at"),
    )


def _merged_chunks(spark, sf_dir, log, stored=None):
    """The stored chunks as a table, the log as a run on top of it, and the table read back."""
    table = ChunkTable(spark, new_dir(spark, "chunks"), share=math.inf)
    table.load(views.stored_chunks(spark, sf_dir) if stored is None else stored)
    table.write(log, "run", views.NOW)
    return _chunk_columns(table.read())


def chunk_upsert(spark, sf_dir):
    log = views.change_log(spark, sf_dir).where("action <> 'delete'")
    return _merged_chunks(spark, sf_dir, log)


def _symbol_files(rows: DataFrame, symbol="symbol") -> DataFrame:
    """Each symbol of a user as a file of its own; no row of the log deletes those of s9."""
    return rows.withColumn("path", F.concat_ws("/", "path", symbol))


def chunk_delete_by_file(spark, sf_dir):
    deletes = _symbol_files(views.change_log(spark, sf_dir)).where("action = 'delete'")
    return _merged_chunks(spark, sf_dir, deletes, _symbol_files(views.stored_chunks(spark, sf_dir)))


def log_replay(spark, sf_dir):
    return _merged_chunks(spark, sf_dir, views.change_log(spark, sf_dir))


def replay_null_and_ties(spark, sf_dir):
    """Every fifth row has no number, and four neighbours share one."""
    seq = F.when(F.col("seq") % 5 != 0, F.floor(F.col("seq") / 4))
    log = views.change_log(spark, sf_dir).withColumn("seq", seq)
    return _merged_chunks(spark, sf_dir, log).select(
        "workspace_id", "path", "symbol", "content", "content_hash", "created_at"
    )


def _merged_points(spark, sf_dir, log, stored=None):
    table = PointTable(spark, new_dir(spark, "points"), share=math.inf)
    table.load(views.stored_points(spark, sf_dir) if stored is None else stored)
    table.write(log, "run", views.NOW)
    return table.read().select(
        "id", "path", vector_text(F.col("vector")).alias("vector"), "payload"
    )


def vector_points(spark, sf_dir):
    return _merged_points(spark, sf_dir, views.change_log(spark, sf_dir))


def vector_delete(spark, sf_dir):
    deletes = _symbol_files(views.change_log(spark, sf_dir)).where("action = 'delete'")
    stored = views.stored_points(spark, sf_dir)
    stored = _symbol_files(stored, F.substring_index("id", "#", -1))
    return _merged_points(spark, sf_dir, deletes, stored)


def point_payload(spark, sf_dir):
    log = views.change_log(spark, sf_dir).where("action <> 'delete'")
    return log.select("seq", "id", replay.point_payload().alias("payload"))


def memory_append(spark, sf_dir):
    return replay.memories(views.change_log(spark, sf_dir), "chunkloom")


def fanout_counts(spark, sf_dir):
    """Write the change log to one table of each kind and count what each one holds."""
    log = views.change_log(spark, sf_dir)
    tables = TableSet(spark, new_dir(spark, "sinks"))
    sinks = [ChunkTable.of(tables), PointTable.of(tables), MemoryTable.of(tables)]
    writer = Writer("run", views.NOW)
    for sink in sinks:
        writer.put(sink, log)
    writer.commit()
    counts = None
    for sink in sinks:
        one = sink.read().agg(F.lit(sink.name).alias("sink"), F.count("*").alias("stored"))
        counts = one if counts is None else counts.unionByName(one)
    return counts


# --- embedding, flow, statistics -------------------------------------------------------


def embed_chunks(spark, sf_dir):
    rows = embed.embed_by_hashing(_plain(spark, sf_dir), DIM)
    return rows.select("path", vector_text(F.col("embedding")).alias("vector"))


def embed_passthrough(spark, sf_dir):
    n = F.col("seq") % 4
    given = F.array(F.lit(1.0), F.lit(2.0)).cast("array<float>")
    recs = (
        _plain(spark, sf_dir)
        .withColumn("embedding", F.when(n == 0, given))
        .withColumn("content", F.when(n == 1, "").otherwise(F.col("content")))
        .withColumn("action", F.when(n == 2, "delete").otherwise(F.col("action")))
    )
    return embed.embed_by_hashing(recs, DIM).select(
        "path", F.coalesce(F.size("embedding"), F.lit(0)).alias("dim"),
        (F.col("embedding") == given).alias("kept"),
    )


def workspace_index(spark, sf_dir):
    """The whole flow: narrow dedup, texts of the changed files, fan-out, embedding."""
    recs = views.records(spark, sf_dir)
    source = TableSource(recs)
    passing = dedup.changed_files(source.fingerprints(), views.old_snapshot(recs))
    # As in a flow, the passing keys are staged.  Their size is then known: while they are few
    # they are broadcast, and the texts are filtered in place instead of shuffled.
    changed = source.fetch(Scratch(spark).staged(passing, "passing"))
    rows = embed.embed_by_hashing(fan_out(changed), DIM)
    return rows.select(
        "workspace_id", "path", "chunk_no", "id", "symbol", "symbol_type", "language",
        "content_hash", vector_text(F.col("embedding")).alias("vector"),
    )


def _some_deleted(spark, sf_dir):
    recs = views.records(spark, sf_dir, views.md_content, [".md"])
    return recs.withColumn("action", F.when(F.col("seq") % 10 == 9, "delete").otherwise("upsert"))


def _reject(rows: DataFrame) -> DataFrame:
    """A step that takes neither long texts, as an embedder with a limit, nor chunks without a symbol."""
    live = F.col("action") != "delete"
    message = F.concat(F.lit("TextTooLong: "), F.length("content").cast("string"))
    error = F.when(live & (F.length("content") > TOO_LONG), message)
    return rows.withColumn("error", error.when(live & (F.col("symbol") == ""), "EmptyName: no symbol"))


def _with_errors(spark, sf_dir):
    """Markdown chunks of which some are rejected, with the stage that did it."""
    long = F.startswith("error", F.lit("TextTooLong"))
    rows = _reject(fan_out(_some_deleted(spark, sf_dir)))
    stage = F.when(long, "embed").when(F.col("error").isNotNull(), "fan_out")
    return rows.withColumn("stage", stage)


def _staged_errors(spark, sf_dir):
    """As in a flow: the rows and the quarantine are written once and read by what follows."""
    scratch = Scratch(spark)
    rows = scratch.staged(_with_errors(spark, sf_dir), "rows")
    return rows, scratch


def file_quarantine(spark, sf_dir):
    rows, scratch = _staged_errors(spark, sf_dir)
    quarantine = scratch.staged(outcome.failed_rows(rows), "quarantine")
    return outcome.good_rows(rows, quarantine).select("path", "chunk_no", "id", "content_hash")


def errors_by_stage(spark, sf_dir):
    return outcome.errors_by_stage(outcome.failed_rows(_with_errors(spark, sf_dir)))


def flow_stats(spark, sf_dir):
    """The counters of a flow over all records, of which a quarter is unchanged since the snapshot."""
    recs = _some_deleted(spark, sf_dir)
    tables = TableSet(spark, new_dir(spark, "flow"))
    snapshot = SnapshotTable.of(tables)
    snapshot.load(views.old_snapshot(recs))
    flow = Flow("stats").source(TableSource(recs)).dedup(snapshot)
    flow.transform("fan_out", fan_out).transform("reject", _reject).sink(ChunkTable.of(tables))
    stats = flow.run("run", views.NOW)
    names = ("records_in", "records_out", "records_skipped", "records_deleted", "records_failed")
    return spark.createDataFrame(
        [tuple(stats[n] for n in names)], ", ".join(f"{n} long" for n in names)
    )


def job_rollup_query(spark, sf_dir):
    return job_rollup(views.job_log(spark, sf_dir))


# --- streaming -------------------------------------------------------------------------


def _event_stream(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    stream = (
        spark.readStream.schema(events.schema)
        .option("pathGlobFilter", "events.parquet")
        .option("maxFilesPerTrigger", 100)
        .parquet(sf_dir)
    )
    return views.shape_events(stream)


def dedup_stream_query(spark, sf_dir):
    out = new_dir(spark, "dedup-stream")
    tables = TableSet(spark, f"{out}/tables")
    passed = VersionTable.of(tables)
    query = dedup_stream(
        _event_stream(spark, sf_dir), tables, [passed], f"{out}/checkpoint",
        snapshot=views.event_snapshot(spark, sf_dir), now=views.NOW,
    )
    query.awaitTermination()
    return passed.read().select("path", "seq")


def replay_stream_query(spark, sf_dir):
    out = new_dir(spark, "replay-stream")
    chunks = ChunkTable(spark, f"{out}/chunks")
    query = replay_stream(
        _event_stream(spark, sf_dir), [chunks], f"{out}/checkpoint", now=views.NOW
    )
    query.awaitTermination()
    return _chunk_columns(chunks.read())


QUERIES = {
    "workspace_index": workspace_index,
    "record_scan": record_scan,
    "relative_path": relative_path,
    "ext_filter": ext_filter,
    "hidden_prune": hidden_prune,
    "language_tag": language_tag,
    "record_id": record_id_query,
    "origin_metadata": origin_metadata,
    "content_hash": content_hash,
    "dedup_snapshot": dedup_snapshot,
    "dedup_sequence": dedup_sequence,
    "dedup_sequence_hot": dedup_sequence_hot,
    "dedup_with_deletes": dedup_with_deletes,
    "dedup_with_deletes_strict": dedup_with_deletes_strict,
    "snapshot_load": snapshot_load,
    "snapshot_upsert": snapshot_upsert,
    "snapshot_delete": snapshot_delete,
    "tombstones": tombstones,
    "markdown_sections": markdown_sections,
    "go_symbols": go_symbols,
    "python_symbols": python_symbols,
    "fanout_mixed": fanout_mixed,
    "whole_file_fallback": whole_file_fallback,
    "chunk_identity": chunk_identity,
    "symbol_collisions": symbol_collisions_query,
    "chunk_upsert": chunk_upsert,
    "chunk_delete_by_file": chunk_delete_by_file,
    "log_replay": log_replay,
    "replay_null_and_ties": replay_null_and_ties,
    "vector_points": vector_points,
    "point_payload": point_payload,
    "vector_delete": vector_delete,
    "memory_append": memory_append,
    "fanout_counts": fanout_counts,
    "embed_chunks": embed_chunks,
    "embed_passthrough": embed_passthrough,
    "file_quarantine": file_quarantine,
    "errors_by_stage": errors_by_stage,
    "flow_stats": flow_stats,
    "job_rollup": job_rollup_query,
    "dedup_stream": dedup_stream_query,
    "replay_stream": replay_stream_query,
}
