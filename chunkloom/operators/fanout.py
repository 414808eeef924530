"""Fan-out of files into chunks: one generator, no shuffle, no second scan.

Each record takes exactly one branch: deletes and other languages pass unchanged, a file with
chunks gives one row per chunk, and a file without any gives itself as one whole-file row.
"""

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.functions.text import hash_content, is_delete, let
from chunkloom.operators.go_symbols import go_chunks
from chunkloom.operators.markdown import markdown_chunks
from chunkloom.operators.python_symbols import python_chunks

# language -> (chunk expression, symbol and type of a file without chunks)
CHUNKERS = {
    "go": (go_chunks, "_file", "file"),
    "python": (python_chunks, "_file", "file"),
    "markdown": (markdown_chunks, "_doc", "section"),
}


def _part(symbol: Column, symbol_type: Column, content: Column, origin: str) -> Column:
    return F.struct(
        symbol.alias("symbol"),
        symbol_type.alias("symbol_type"),
        content.alias("content"),
        F.lit(origin).alias("origin"),
    )


def _parts(chunks: Column, fallback: Column) -> Column:
    return let(
        chunks,
        lambda found: F.when(
            F.size(found) > 0,
            F.transform(found, lambda c: _part(c.symbol, c.symbol_type, c.content, "chunk")),
        ).otherwise(F.array(fallback)),
    )


@lru_cache(maxsize=1)
def _all_parts(application_id: str) -> Column:
    """The chunks of one record, whatever its branch.

    The expression is large and always the same, so an application builds it once.
    """
    content, language = F.col("content"), F.col("language")
    unchanged = F.array(_part(F.col("symbol"), F.col("symbol_type"), content, "pass"))
    parts = F.when(F.col("action") == "delete", unchanged)
    for name, (chunker, symbol, kind) in CHUNKERS.items():
        whole = _part(F.lit(symbol), F.lit(kind), content, "whole")
        parts = parts.when(language == name, _parts(chunker(content), whole))
    return parts.otherwise(unchanged)


def fan_out(records: DataFrame) -> DataFrame:
    """Records to chunk rows; adds ``file_id``, ``chunk_no`` and ``origin``.

    ``origin`` is ``chunk``, ``whole`` (a file without chunks) or ``pass`` (not chunked).
    """
    parts = _all_parts(records.sparkSession.sparkContext.applicationId)
    # The file text travels only inside `parts`, so the generator does not repeat it per chunk.
    kept = [c for c in records.columns if c not in ("symbol", "symbol_type", "content")]
    rows = records.select(*kept, F.posexplode(parts).alias("chunk_no", "part"))
    chunk = F.col("part.origin") == "chunk"
    computed = {
        "file_id": F.col("id"),
        "id": F.when(chunk, F.concat_ws("#", F.col("id"), F.col("part.symbol"))).otherwise(
            F.col("id")
        ),
        "symbol": F.col("part.symbol"),
        "symbol_type": F.col("part.symbol_type"),
        "content": F.col("part.content"),
        "content_hash": F.when(
            F.col("part.origin") == "pass", F.col("content_hash")
        ).otherwise(hash_content(F.col("part.content"))),
        "embedding": F.when(~chunk, F.col("embedding")),
        "metadata": F.when(
            chunk, F.coalesce(F.col("metadata"), F.create_map().cast("map<string,string>"))
        ).otherwise(F.col("metadata")),
        "action": F.when(chunk, "upsert").otherwise(F.col("action")),
        "chunk_no": F.col("chunk_no"),
        "origin": F.col("part.origin"),
    }
    untouched = [c for c in kept if c not in computed]
    return rows.select(*untouched, *[col.alias(name) for name, col in computed.items()])


def symbol_collisions(chunks: DataFrame) -> DataFrame:
    """Keys that occur more than once; keyed tables keep the last of them."""
    return (
        chunks.where(~is_delete(F.col("action")))
        .groupBy("workspace_id", "path", "symbol")
        .agg(F.count("*").alias("copies"))
        .where("copies > 1")
    )
