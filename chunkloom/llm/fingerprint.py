"""Context-triggered piecewise hashing: fingerprints of texts, compared by edit distance.

A rolling hash over the last ``CONTEXT`` bytes ends a chunk where its lowest bits are all set: at block size 2**k
after k of them. So chunks depend on the bytes around their ends only, and an edit changes the chunks it touches. A
signature is a code of two characters for every chunk's hash. A fingerprint is ``size:signature:signature`` at
the smallest block size that gives at most ``CHUNKS`` chunks, and at twice that size. Chunks of whole texts are hashed.

Two fingerprints are compared where they hold signatures of one block size: the likeness is 1 less the edit distance
(insert, delete, replace) as a share of the longer signature, the best if two sizes are common, and 0 without a common
size. Equal fingerprints have likeness 1, so equal texts have. A null text is an empty text; its signatures are empty,
and it is like empty texts only.

``edited`` pairs every row with the next one. Rows are dealt out by ranges of ids, each text once, and walked in order;
only the first and last row of each range meet outside of it. Repeated ids follow each other by text, null ids come
first. A table of one row follows itself. Other columns are ignored, whatever their names.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkloom.llm.numeric import BLOCK_BYTES, U, bytes_sequence, text_blocks, word_hashes
from chunkloom.llm.stage import Stage

CONTEXT = 7
LEAST_BITS = 2
CHUNKS = 64
_CODE = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_PAIR = "id {}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_WALKED = _PAIR + ", end int, text string"


def _triggers(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of chunks at the least block size, and how many low bits are set there; in pieces of a block."""
    ends, bits = [], []
    low = U((1 << LEAST_BITS) - 1)
    for lo in range(0, len(buf), BLOCK_BYTES):
        grams = bytes_sequence(buf[lo : lo + BLOCK_BYTES + CONTEXT - 1], 0).grams(CONTEXT)[:BLOCK_BYTES]
        at = np.flatnonzero((grams & low) == low)
        unset = ~grams[at]
        ends.append(at + (lo + CONTEXT))
        bits.append(np.frexp((unset & (U(0) - unset)).astype(float))[1] - 1)
    if not ends:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    end, bit = np.concatenate(ends), np.concatenate(bits)
    text = np.searchsorted(offsets, end, side="left") - 1
    inside = end - CONTEXT >= offsets[text]
    return end[inside], np.minimum(np.where(bit[inside] < 0, 62, bit[inside]), 62)


def _signatures(buf: np.ndarray, offsets: np.ndarray, end: np.ndarray, text: np.ndarray) -> list[str]:
    """One signature a text; what follows its last trigger is its last chunk."""
    filled = np.flatnonzero(np.diff(offsets))
    ends = np.unique(np.concatenate((end, offsets[filled + 1])))
    starts = np.concatenate(([0], ends[:-1]))
    code = (word_hashes(buf, starts, ends, 0) & U(4095)).astype(np.int64) if len(ends) else ends
    chars = np.column_stack((_CODE[code >> 6], _CODE[code & 63])).tobytes().decode()
    cut = (2 * np.searchsorted(ends, offsets, side="right")).tolist()
    return [chars[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def fingerprints_of(buf: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Fingerprints of the texts of a block."""
    m = len(offsets) - 1
    end, bit = _triggers(buf, offsets)
    text = np.searchsorted(offsets, end, side="left") - 1
    counts = np.zeros((m, 64), np.int64)
    np.add.at(counts, (text, bit), 1)
    at_least = counts[:, ::-1].cumsum(axis=1)[:, ::-1]
    few = at_least[:, LEAST_BITS:] < CHUNKS  # the last chunk needs no trigger
    k = LEAST_BITS + few.argmax(axis=1)
    fine, coarse = bit >= k[text], bit >= k[text] + 1
    first = _signatures(buf, offsets, end[fine], text[fine])
    second = _signatures(buf, offsets, end[coarse], text[coarse])
    return [f"{1 << b}:{x}:{y}" for b, x, y in zip(k.tolist(), first, second, strict=True)]


def edit_distance(a: str, b: str) -> int:
    """Between signatures, in chunks: one column of the distance table at a time, as bits of two numbers."""
    xs = [a[i : i + 2] for i in range(0, len(a), 2)]
    ys = [b[i : i + 2] for i in range(0, len(b), 2)]
    if not xs or not ys:
        return max(len(xs), len(ys))
    where: dict[str, int] = {}
    for i, x in enumerate(xs):
        where[x] = where.get(x, 0) | 1 << i
    full, last, distance = (1 << len(xs)) - 1, 1 << (len(xs) - 1), len(xs)
    plus, minus = full, 0
    for y in ys:
        match = where.get(y, 0)
        diagonal = (((match & plus) + plus) ^ plus) | match | minus
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        distance += 1 if up & last else -1 if down & last else 0
        up = up << 1 | 1
        plus = (down << 1 | ~(diagonal | up)) & full
        minus = up & diagonal & full
    return distance


def likeness_of(a: str, b: str) -> float:
    if a == b:
        return 1.0
    (size_a, *of_a), (size_b, *of_b) = a.split(":"), b.split(":")
    mine = {int(size_a) << i: s for i, s in enumerate(of_a)}
    best = 0.0
    for i, other in enumerate(of_b):
        own = mine.get(int(size_b) << i)
        if own and other:
            best = max(best, 1 - 2 * edit_distance(own, other) / max(len(own), len(other)))
    return best


def _all_fingerprints(column: pa.Array) -> list[str]:
    return [f for _, _, buf, offsets in text_blocks(column) for f in fingerprints_of(buf, offsets)]


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text column."""

    @F.arrow_udf("string")
    def of(column: pa.Array) -> pa.Array:
        return pa.array(_all_fingerprints(column), pa.string())

    return of(F.coalesce(text.cast("string"), F.lit("")))


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two columns of fingerprints, 0 to 1; null if one is null."""

    @F.arrow_udf("double")
    def of(x: pa.Array, y: pa.Array) -> pa.Array:
        pairs = zip(x.to_pylist(), y.to_pylist(), strict=True)
        return pa.array([None if None in p else likeness_of(*p) for p in pairs], pa.float64())

    return of(a, b)


def _compared(ids: pa.Array, texts: list[str], prints: list[str], following: list[tuple[str, str]], share: int):
    """Result columns of rows whose next rows have the texts and fingerprints ``following``."""
    edited = [
        t[: len(t) - len(t) // share] + after[: len(t) // share] for t, (after, _) in zip(texts, following, strict=True)
    ]
    other = _all_fingerprints(pa.array(edited, pa.large_string()))
    return [
        ids,
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
        pa.array(prints, pa.string()),
        pa.array(other, pa.string()),
        pa.array([likeness_of(p, q) for p, q in zip(prints, other, strict=True)], pa.float64()),
        pa.array([likeness_of(p, q) for p, (_, q) in zip(prints, following, strict=True)], pa.float64()),
    ]


def _walk(names: list[str], share: int):
    """Compares neighbours of one range. Its first and last rows come back with texts: ``end`` 0 and 1."""

    def batch_of(columns, end, texts):
        n = len(columns[0])
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array([end] * n, pa.int32()), pa.array(texts or [None] * n, pa.string())],
            names=[*names, "end", "text"],
        )

    def edge(row, end):
        id_, text, _ = row
        nothing = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())]
        return batch_of([id_, *nothing], end, [text])

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            column, texts = batch.column("text"), batch.column("text").to_pylist()
            prints = _all_fingerprints(column)
            ids = batch.column("id")
            if held is None:
                yield edge((ids.slice(0, 1), texts[0], prints[0]), 0)
            else:
                yield batch_of(_compared(held[0], [held[1]], [held[2]], [(texts[0], prints[0])], share), None, None)
            n = batch.num_rows - 1
            after = list(zip(texts[1:], prints[1:], strict=True))
            if n:
                yield batch_of(_compared(ids.slice(0, n), texts[:n], prints[:n], after, share), None, None)
            held = (ids.slice(n, 1), texts[n], prints[n])
        if held is not None:
            yield edge(held, 1)

    return run


def _meet(names: list[str], share: int):
    def run(batches):
        for batch in batches:
            texts, after = batch.column("text").to_pylist(), batch.column("after").to_pylist()
            prints = _all_fingerprints(batch.column("text"))
            following = list(zip(after, _all_fingerprints(batch.column("after")), strict=True))
            columns = _compared(batch.column("id"), texts, prints, following, share)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def edited(
    docs: DataFrame, share: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row its fingerprint and that of an edited text, and how like they and the next row's are.

    The edited text has the last 1/``share`` of the code points, rounded down, replaced by as many from the start of
    the next row's text, or by all of it if it is shorter. Columns: ``id``, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.
    """
    stage = Stage(docs.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    kind = dict(rows.dtypes)["id"]
    names = [c.split()[0] for c in _PAIR.split(", ")]
    rows = rows.withColumns({"h": F.xxhash64("text"), "tie": F.monotonically_increasing_id()})
    order = ["id", "h", "tie"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    walked = dealt.mapInArrow(_walk(names, share), _WALKED.format(kind))
    walked = stage.table(walked.withColumn("part", F.spark_partition_id()), "walked")

    # the last row of a range and the first of the next range; two rows a range
    ends = walked.where("end IS NOT NULL").select("id", "part", "end", "text")
    first, last = ends.where("end = 0"), ends.where("end = 1")
    parts = first.select("part")
    everywhere = Window.orderBy("part")  # numbers of ranges only
    following = parts.select(
        "part",
        F.coalesce(F.lead("part").over(everywhere), F.min("part").over(Window.partitionBy())).alias("next"),
    )
    after = first.select(F.col("part").alias("next"), F.col("text").alias("after"))
    pairs = last.join(following, "part").join(after, "next").select("id", "text", "after")
    met = pairs.mapInArrow(_meet(names, share), _PAIR.format(kind))
    return walked.where("end IS NULL").select(*names).unionByName(met)
