"""Table schemas.  Keys: records (workspace_id, path, seq); snapshot (workspace_id, path);
chunks (workspace_id, path, symbol); points id; memories have none (append-only)."""

from pyspark.sql import types as T

EMBEDDING = T.ArrayType(T.FloatType(), containsNull=False)
METADATA = T.MapType(T.StringType(), T.StringType())


def _struct(spec: str) -> T.StructType:
    """Build a struct from ``"name type, name type"``."""
    kinds = {
        "string": T.StringType(),
        "long": T.LongType(),
        "int": T.IntegerType(),
        "timestamp": T.TimestampType(),
        "binary": T.BinaryType(),
        "vector": EMBEDDING,
        "map": METADATA,
    }
    fields = [f.split() for f in spec.split(",")]
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in fields])


# One row per version of a file.  `seq` is the arrival order the source assigns; `error`
# holds the reason a file could not be read or embedded.
RECORDS = _struct(
    "id string, workspace_id string, path string, symbol string, symbol_type string, "
    "language string, content string, content_hash string, embedding vector, metadata map, "
    "action string, seq long"
)
SNAPSHOT = _struct("workspace_id string, path string, content_hash string, updated_at timestamp")
CHUNKS = _struct(
    "workspace_id string, path string, symbol string, symbol_type string, language string, "
    "content string, content_hash string, embedding vector, metadata string, "
    "created_at timestamp, updated_at timestamp"
)
POINTS = _struct("id string, workspace_id string, path string, vector vector, payload string")
VERSIONS = _struct("workspace_id string, path string, seq long, action string, content_hash string")
MEMORIES = _struct("content string, metadata string")
JOB_EVENTS = _struct(
    "job_id string, workspace_id string, seq long, ts timestamp, kind string, status string, "
    "error_msg string, total_files long, files long"
)
QUARANTINE = _struct(
    "run_id string, workspace_id string, file_id string, path string, stage string, "
    "error_type string, message string, seen_at timestamp"
)
