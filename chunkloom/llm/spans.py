"""Rows of a document brought together with positions found in it."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.stage import same_row


def per_row(ranges: DataFrame) -> DataFrame:
    """Columns ``id``, ``h`` and all ranges of that row; their number is bounded by the text's length."""
    inside = [c for c in ranges.columns if c not in ("id", "h")]
    return ranges.groupBy("id", "h").agg(F.collect_list(F.struct(*inside)).alias("ranges"))


def with_ranges(docs: DataFrame, ranges: DataFrame, how: str) -> DataFrame:
    listed = per_row(ranges)
    kept = [docs[c] for c in docs.columns]
    return docs.join(listed, same_row(docs, listed), how).select(*kept, listed["ranges"])


def range_arrays(column: pa.ListArray, *fields: str):
    """For every row of an Arrow column of ranges, its fields (``lo`` and ``n``) as arrays."""
    flat = column.values
    each = [
        flat.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in fields or ("lo", "n")
    ]
    offsets = column.offsets.to_numpy()
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        a, b = (offsets[i], offsets[i + 1]) if valid[i] else (0, 0)
        yield [values[a:b] for values in each]
