"""Substring dedup over words: seed with winnowed anchors, extend both ways, keep maximal repeats.

A window is ``length`` consecutive words of one document. A word is removed if it lies in a window
whose word sequence also starts in a document with a smaller id. What is removed is decided on the
input alone.

1. Seed. Winnowing picks the smallest hash of ``anchor`` consecutive words among those inside a window,
   so equal windows pick equal anchors. One row stands for a run of neighbouring windows that share
   an anchor: about one row per twenty words. Rows whose anchor occurs in one document only are
   dropped after a count.
2. Extend. A seed is first extended both ways over its whole run: the run reaches as far left and
   right as a window through the anchor can. Rows with equal runs form a class, and all but those of
   the class's smallest id are done, however many copies there are. Only the first row of each class is then
   extended window by window against the other classes of its anchor (the ends of shared passages), so
   the work grows with the edges of passages and not with pairs of copies.
3. Merge. Matched windows of a document are joined to maximal repeats.

Null, empty or short texts have no windows. Rows without an id come after every id: they can lose
words and never cause a loss. Rows that share an id count as one document. Equality of runs and
windows is equality of 128-bit hashes. Other columns are not touched, whatever their names.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.numeric import (
    U,
    Sequence,
    merge_spans,
    minimizer_runs,
    mix,
    signed,
    spread_ranges,
    text_blocks,
    word_hashes,
    words,
)
from chunkloom.llm.spans import range_arrays, with_ranges
from chunkloom.llm.stage import Stage, keyed

LENGTH = 50
ANCHOR = 13
_SEED = "id {}, h long, a long, c1 long, c2 long, lo int, n int"
_WINDOW = "id {}, h long, w1 long, w2 long, lo int"
_RESULT = "id {}, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept string"


def _seeds(length: int, anchor: int):
    def run(batches):
        for batch in batches:
            for first, _, buf, offsets in text_blocks(batch.column("text")):
                starts, ends, text = words(buf, offsets)
                n = len(starts)
                if n < length:
                    continue
                one = Sequence(word_hashes(buf, starts, ends, 0), 0)
                grams = one.grams(anchor)
                valid = text[: n - length + 1] == text[length - 1 :]
                lo, hi, p = minimizer_runs(grams, length - anchor + 1, valid)
                if not len(lo):
                    continue
                two = Sequence(word_hashes(buf, starts, ends, 1), 1)
                shape = mix(((p - lo) * 1_000_003 + (hi - lo)).astype(U))
                row = text[lo]
                begin = np.searchsorted(text, row)
                take = pa.array(first + row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(take),
                        batch.column("h").take(take),
                        signed(mix(grams[p])),
                        signed(one.hashes(lo, hi + length) ^ shape),
                        signed(two.hashes(lo, hi + length)),
                        pa.array((lo - begin).astype(np.int32)),
                        pa.array((hi - lo + 1).astype(np.int32)),
                    ],
                    names=["id", "h", "a", "c1", "c2", "lo", "n"],
                )

    return run


def _windows(length: int):
    def run(batches):
        for batch in batches:
            ranges = list(range_arrays(batch.column("ranges")))
            for first, last, buf, offsets in text_blocks(batch.column("text")):
                starts, ends, text = words(buf, offsets)
                one = Sequence(word_hashes(buf, starts, ends, 0), 0)
                two = Sequence(word_hashes(buf, starts, ends, 1), 1)
                begins = np.searchsorted(text, np.arange(last - first))
                for row in range(first, last):
                    at, _ = spread_ranges(*ranges[row])
                    at = np.unique(at)
                    s = at + begins[row - first]
                    take = pa.array(np.full(len(at), row))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("id").take(take),
                            batch.column("h").take(take),
                            signed(one.hashes(s, s + length)),
                            signed(two.hashes(s, s + length)),
                            pa.array(at.astype(np.int32)),
                        ],
                        names=["id", "h", "w1", "w2", "lo"],
                    )

    return run


def _cut(batches):
    """Ranges are [lo, lo + n) in words."""
    for batch in batches:
        total, removed, spans, kept = [], [], [], []
        for text, (lo, n) in zip(
            batch.column("text"), range_arrays(batch.column("ranges")), strict=True
        ):
            found = text.as_py().encode().split()
            start, end = merge_spans(lo, lo + n)
            spans.append([{"start": a, "end": b} for a, b in zip(start.tolist(), end.tolist())])
            total.append(len(found))
            removed.append(int((end - start).sum()))
            if len(start):
                edges = [0, *np.column_stack((start, end)).ravel().tolist(), len(found)]
                found = [w for a, b in zip(edges[::2], edges[1::2]) for w in found[a:b]]
            kept.append(b" ".join(found).decode())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                pa.array(total, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                pa.array(kept, pa.string()),
            ],
            names=["id", "n_words", "n_removed", "spans", "kept"],
        )


def repeated_ranges(
    stage: Stage, rows: DataFrame, length: int = LENGTH, anchor: int = ANCHOR
) -> DataFrame:
    """Ranges of words (``id``, ``h``, ``lo``, ``n``) that repeat an earlier document; they may overlap."""
    kind = dict(rows.dtypes)["id"]
    narrow = rows.select("id", "h", "text")
    seeds = stage.table(narrow.mapInArrow(_seeds(length, anchor), _SEED.format(kind)), "seeds")

    # seed: anchors of more than one document
    shared = stage.table(
        seeds.groupBy("a")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("id").alias("ids"),
             F.count("*").alias("all"))
        .where("low < high OR (ids > 0 AND ids < all)")
        .select("a"),
        "anchors",
    )
    met = stage.table(seeds.join(shared, "a", "left_semi"), "met")
    stage.drop(seeds, shared)

    # extend over the whole run
    key = ["a", "c1", "c2"]
    classes = stage.table(met.groupBy(*key).agg(F.min("id").alias("first")), "classes")
    several = stage.table(
        classes.groupBy("a").agg(F.count("*").alias("k")).where("k > 1").select("a"), "several"
    )
    placed = met.join(classes, key)
    repeats = placed.where("first < id OR (id IS NULL AND first IS NOT NULL)").select(
        "id", "h", "lo", (F.col("n") + (length - 1)).alias("n")
    )

    # extend window by window where classes of one anchor differ
    open_runs = placed.where("first <=> id").select("id", "h", "a", "lo", "n")
    open_runs = stage.table(
        open_runs.join(several, "a", "left_semi").select("id", "h", "lo", "n"), "open"
    )
    windows = stage.table(
        with_ranges(narrow, open_runs, "inner").mapInArrow(_windows(length), _WINDOW.format(kind)),
        "windows",
    )
    best = stage.table(
        windows.groupBy("w1", "w2").agg(F.min("id").alias("first"), F.max("id").alias("last"),
                                        F.count("id").alias("ids"), F.count("*").alias("all"))
        .where("first < last OR (ids > 0 AND ids < all)")
        .select("w1", "w2", "first"),
        "best",
    )
    edges = (
        windows.join(best, ["w1", "w2"])
        .where("first < id OR (id IS NULL AND first IS NOT NULL)")
        .select("id", "h", "lo", F.lit(length).alias("n"))
    )
    found = stage.table(repeats.unionByName(edges), "ranges")
    stage.drop(met, classes, several, open_runs, windows, best)
    return found


def substring_dedup(
    docs: DataFrame,
    length: int = LENGTH,
    anchor: int = ANCHOR,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: ``id``, ``n_words``, ``n_removed``, ``spans`` (maximal repeats in words) and ``kept``."""
    stage = Stage(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    found = repeated_ranges(stage, rows, length, anchor)
    listed = with_ranges(rows, found, "left")
    return listed.mapInArrow(_cut, _RESULT.format(dict(rows.dtypes)["id"]))
