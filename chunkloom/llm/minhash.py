"""Near-duplicate documents by word shingles: fast similarity sketches, banding, exact verification.

A document's set holds its distinct ``shingle``-word shingles after lower-casing A-Z (a shorter text's one
sequence; no words: the empty set, linked with nothing). Documents with
``100 * intersection >= percent * union`` are linked; groups are what links connect.

* Sketch (Dahlgaard, Knudsen and Thorup, 2017). Round i throws every shingle into one of t bins with a value in
  [i, i + 1); a bin keeps its least value. Rounds go on until all bins are full; from round t on, round
  t + j throws everything into bin j, so each coordinate fills. Equal bins estimate the similarity with the
  concentration of independent hashing in O(t log t + n) time.
* Bands of ``rows`` coordinates make buckets. With 48 bands of 5 rows, a pair at similarity 0.85 shares no
  bucket with probability 6e-13, at 0.80 with 5e-9.
* Verify on whole sets. Equal sets are one class from the start. Shingles that no other candidate
  has bound every similarity from above: with q of n and p of m such shingles, the intersection is at most
  min(n - q, m - p). First every class meets the class of each of its buckets that has the smallest share of them,
  which is the most central; links found join groups, and what the two share is kept. Then, only around centres
  whose classes are still in different groups, the classes outside the largest group meet those of other groups
  they share a bucket with. Two classes that share i and j shingles with their centre share at most min(i, j) of
  its shingles and min(n - q - i, m - p - j) others. No pair inside a joined group is built, however
  large the group; each other pair is excluded by a bound or verified.

Rows without an id link with nothing and are kept. Rows that share an id are one document to the links, with
all their shingles.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.links import components
from chunkloom.llm.numeric import U, Sequence, mix, signed, text_blocks, word_hashes, words
from chunkloom.llm.stage import Stage, keyed, same_row, without

SHINGLE = 5
PERCENT = 80
BANDS = 48
ROWS = 5
_LOW = U(0xFFFFFFFF)
_SEEDS = mix(np.arange(1, 4096, dtype=U) * U(0x9E3779B97F4A7C15))


def sketch(elements: np.ndarray, bins: int) -> np.ndarray:
    """One value for each bin; elements are distinct 64-bit hashes, at least one."""
    empty = ~U(0)
    out = np.full(bins, empty, U)
    i, n = 0, len(elements)
    while i < bins and (out == empty).any():
        rounds = min(bins - i, max(1, min(bins, 4096 // n)))
        hashed = mix(elements[None, :] ^ _SEEDS[i : i + rounds, None])
        bin_of = ((hashed >> U(32)) * U(bins)) >> U(32)
        number = np.arange(i, i + rounds, dtype=U)[:, None] << U(32)
        np.minimum.at(out, bin_of.ravel().astype(np.int64), (number | (hashed & _LOW)).ravel())
        i += rounds
    for j in np.flatnonzero(out == empty):
        last = mix(elements ^ _SEEDS[bins + j]) & _LOW
        out[j] = (U(bins + j) << U(32)) | last.min()
    return out


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    table = values.reshape(-1, rows)
    key = mix(np.arange(1, len(table) + 1, dtype=U))
    for j in range(rows):
        key = mix(key ^ (table[:, j] * U(2 * j + 3)))
    return key


def _sets(batch: pa.RecordBatch, k: int):
    """(row, distinct shingle hashes) of every row of a batch."""
    for first, last, buf, offsets in text_blocks(batch.column("text")):
        starts, ends, text = words(buf, offsets)
        sequence = Sequence(word_hashes(buf, starts, ends, 0, lower=True), 0)
        grams = sequence.grams(k)
        begins = np.searchsorted(text, np.arange(last - first + 1)).tolist()
        for row in range(first, last):
            a, b = begins[row - first], begins[row - first + 1]
            if b - a >= k:
                yield row, np.unique(grams[a : b - k + 1])
            elif b > a:
                whole = sequence.hashes(np.array([a]), np.array([b]))
                yield row, mix(whole ^ U(b - a))
            else:
                yield row, grams[:0]


def _sketches(k: int, bands: int, rows: int):
    def run(batches):
        for batch in batches:
            n, one, two, keys = [], [], [], []
            for _, found in _sets(batch, k):
                n.append(len(found))
                one.append(mix(found ^ _SEEDS[4093]).sum(dtype=U))
                two.append(mix(found ^ _SEEDS[4094]).sum(dtype=U))
                made = band_keys(sketch(found, bands * rows), rows) if len(found) else found
                keys.append(made.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("h"),
                    pa.array(n, pa.int64()),
                    signed(np.array(one, U)),
                    signed(np.array(two, U)),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["id", "h", "n", "s1", "s2", "bands"],
            )

    return run


def _full_sets(k: int):
    def run(batches):
        for batch in batches:
            rows = [(row, found.view(np.int64)) for row, found in _sets(batch, k)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([found for _, found in rows], pa.list_(pa.int64())),
                ],
                names=["id", "elements"],
            )

    return run


def _measured(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` with the size of their intersection and whether their full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("elements").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("elements").alias("right"))
    all_of = F.size("left") + F.size("right")
    both = F.col("both")
    return (
        pairs.join(right, "b")
        .join(left, "a")
        .select("a", "b", F.size(F.array_intersect("left", "right")).alias("both"), all_of.alias("all_of"))
        .select("a", "b", "both", (100 * both >= percent * (F.col("all_of") - both)).alias("linked"))
    )


def _possible(n, q, m, p, percent: int, i=None, j=None):
    """Whether sets of n and m shingles, q and p of them found nowhere else, can be similar enough.

    Given i and j, what each shares with one third set (null if unknown), they meet in at most the lesser of
    those inside it, and outside it in the lesser of what is left of each.
    """
    both = F.least(n - q, m - p)
    if i is not None:
        apart = F.least(i, j) + F.least(n - q - i, m - p - j)
        both = F.when(i.isNotNull() & j.isNotNull(), apart).otherwise(both)  # least() skips nulls
    return 100 * both >= percent * (n + m - both)


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: ``id``, ``h`` (text hash), ``n_shingles``, ``component_id`` and ``kept``."""
    stage = Stage(docs.sparkSession)
    texts = keyed(docs, id_col, text_col)
    kind = dict(texts.dtypes)["id"]
    made = stage.table(
        texts.mapInArrow(
            _sketches(shingle, bands, rows),
            f"id {kind}, h long, n long, s1 long, s2 long, bands array<long>",
        ),
        "sketches",
    )
    # equal sets: the least document stands for all
    known = made.where("n > 0 AND id IS NOT NULL")
    least = known.groupBy("s1", "s2", "n").agg(F.min(F.struct("id", "h")).alias("r"))
    classes = stage.table(
        least.select("s1", "s2", "n", F.col("r.id").alias("rep"), F.col("r.h").alias("rep_h")),
        "classes",
    )
    stands = classes.select(
        F.col("rep").alias("id"), F.col("rep_h").alias("h"), F.col("s1").alias("t1"), F.col("s2").alias("t2")
    )
    chosen = (
        known.join(stands, same_row(known, stands) & (F.col("s1") == F.col("t1")) & (F.col("s2") == F.col("t2")))
        .select(known["id"], known["h"], "n", "bands")
        .dropDuplicates(["id", "h"])
    )
    spread = chosen.select("id", "h", "n", F.explode("bands").alias("bucket"))
    spread = stage.table(spread, "bands")
    full = stage.table(
        spread.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .where("low < high").select("bucket"),
        "buckets",
    )
    members = stage.table(spread.join(full, "bucket"), "members")
    stage.drop(spread, full)
    wanted = members.select("id", "h").distinct()
    kept = [texts[c] for c in texts.columns]
    sets = stage.table(
        texts.join(wanted, same_row(texts, wanted), "left_semi")
        .select(*kept)
        .mapInArrow(_full_sets(shingle), f"id {kind}, elements array<long>")
        .groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("elements"))).alias("elements")),
        "sets",
    )

    # every class with the most central one of each bucket
    elements = sets.select("id", F.explode("elements").alias("e"))
    lone = elements.groupBy("e").agg(F.min("id").alias("id"), F.count("*").alias("k")).where("k = 1")
    own = stage.table(lone.groupBy("id").agg(F.count("*").alias("own")), "own")
    rated = sets.select("id", F.size("elements").cast("long").alias("n")).join(own, "id", "left")
    rated = stage.table(
        members.select("bucket", "id").join(
            rated.select("id", "n", F.coalesce("own", F.lit(0)).alias("q")), "id"
        ),
        "rated",
    )
    stage.drop(members, own)
    centre = F.min(F.struct((F.col("q") / F.col("n")).alias("share"), "id", "n", "q")).alias("r")
    pivots = stage.table(
        rated.groupBy("bucket").agg(centre).select(
            "bucket", F.col("r.id").alias("x"), F.col("r.n").alias("m"), F.col("r.q").alias("p")
        ),
        "pivots",
    )
    pair = [F.least("x", "id").alias("a"), F.greatest("x", "id").alias("b")]
    possible = _possible(F.col("n"), F.col("q"), F.col("m"), F.col("p"), percent)
    stars = rated.join(pivots, "bucket").where((F.col("x") != F.col("id")) & possible)
    stars = stage.table(stars.select(*pair).distinct(), "stars")
    met = stage.table(_measured(stars, sets, percent), "met")
    links = met.where("linked").select("a", "b")
    labels = stage.table(components(stage, links), "labels")

    # centres whose classes are in several groups: those outside the largest group with the others
    node = labels.select(F.col("node").alias("id"), "label")
    around = (
        rated.join(pivots.select("bucket", "x"), "bucket")
        .groupBy("x", "id", "n", "q").agg(F.collect_set("bucket").alias("buckets"))
        .select("*", *pair)
    )
    inside = F.when(F.col("x") == F.col("id"), F.col("n") - F.col("q")).otherwise(F.col("both").cast("long"))
    placed = stage.table(
        around.join(met.select("a", "b", "both"), ["a", "b"], "left")
        .join(node, "id", "left")
        .select("x", "id", "n", "q", "buckets", inside.alias("i"), F.coalesce("label", "id").alias("label")),
        "placed",
    )
    stage.drop(stars, pivots)
    groups = placed.groupBy("x", "label").agg(F.count("*").alias("k"))
    mixed = stage.table(
        groups.groupBy("x")
        .agg(F.max(F.struct("k", "label")).alias("most"), F.count("*").alias("groups"))
        .where("groups > 1")
        .select("x", F.col("most.label").alias("main")),
        "mixed",
    )
    rest = stage.table(placed.join(mixed, "x"), "rest")
    few = rest.where("label <> main").select(
        "x", F.col("id").alias("c"), F.col("n").alias("m"), F.col("q").alias("p"), F.col("i").alias("j"),
        F.col("label").alias("other"), F.col("buckets").alias("theirs"),
    )
    able = few.where(_possible(F.col("m"), F.col("p"), F.col("m") - F.col("p"), F.lit(0), percent))
    possible = _possible(
        F.col("n"), F.col("q"), F.col("m"), F.col("p"), percent, F.col("i"), F.col("j")
    )
    crossed = able.join(rest, "x").where(
        (F.col("other") != F.col("label")) & possible & F.arrays_overlap("buckets", "theirs")
    )
    crossed = crossed.select(F.least("c", "id").alias("a"), F.greatest("c", "id").alias("b")).distinct()
    crossed = stage.table(crossed, "crossed")
    found = _measured(crossed, sets, percent).where("linked").select("a", "b")
    more = stage.table(links.unionByName(found), "verified")
    labels = stage.table(components(stage, more), "labels")
    stage.drop(rated, sets, met, placed, mixed, rest, crossed, more)

    owner = classes.select("s1", "s2", F.col("n").alias("size"), "rep")
    component = F.coalesce("label", "rep", "id")
    return (
        made.select("id", "h", "n", "s1", "s2")
        .join(
            owner,
            (made["s1"] == owner["s1"]) & (made["s2"] == owner["s2"]) & (made["n"] == owner["size"])
            & made["id"].isNotNull(),
            "left",
        )
        .join(labels, F.col("rep") == F.col("node"), "left")
        .select(
            "id", "h", F.col("n").alias("n_shingles"), component.alias("component_id"),
            F.col("id").eqNullSafe(component).alias("kept"),
        )
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings
) -> DataFrame:
    """One row of each group, with all its columns: the one with the smallest id.

    Rows that repeat id and text are one document too; of those any one stays.
    """
    stage = Stage(docs.sparkSession)
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **settings)
    found = stage.table(found.select("id", "h", "kept"), "found")
    left = without(docs, found.where("NOT kept").select("id", "h").distinct(), id_col, text_col)
    again = found.where("kept").groupBy("id", "h").agg(F.count("*").alias("k")).where("k > 1")
    again = stage.table(again.select("id", "h"), "again")
    if again.isEmpty():
        return left
    rows = keyed(left, id_col, text_col, keep_row=True)
    marked = again.withColumnsRenamed({"id": "key", "h": "key_h"})
    rows = rows.join(marked, F.col("id").eqNullSafe(F.col("key")) & (F.col("h") == F.col("key_h")), "left")
    single = rows.where("key_h IS NULL").select("row.*")
    once = rows.where("key_h IS NOT NULL").dropDuplicates(["id", "h"]).select("row.*")
    return single.unionByName(once)
