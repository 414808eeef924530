"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one representative a group.

* Fit. Spherical k-means on at most ``SAMPLE`` vectors (the first by a hash), with about one centre for each
  ``CELL`` vectors and at most ``MAX_CELLS``, so the centres have a fixed size and are broadcast.
* Assign. A vector lives in the cell of its nearest centre and also visits each cell i whose border with
  its own cell h is near: a pair at the threshold is ``chord`` apart, in d dimensions the part of that across
  one border is about chord / sqrt(d), and one of the two is nearer to the border than half of it. So the cell is
  visited if the distance x . (c_h - c_i) / |c_h - c_i| is within ``REACH / 2`` times that. No number of visits is
  fixed, and every row is assigned.
* Compare. A cell's own rows and its own rows with its visitors are cut into blocks of about ``BLOCK`` by hash, and
  each pair of blocks is one product of double-precision matrices in one task. A task returns counts and a spanning forest of its links, never
  the pairs. A pair that two cells see is counted in the one with the smaller number.
* Group. Connected components of the links; the smallest id represents a group.

Equal vectors are compared once and counted as often as they occur. Vectors that are null, empty, zero, or hold a
null or non-finite component, and rows without an id, link with nothing and are kept. Vectors are compared with
those of their own length only; lengths other than the commonest have a single cell each. Rows that
repeat an id are further vectors with the same id.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.links import components
from chunkloom.llm.stage import Stage

SAMPLE = 20_000
CELL = 1_000
MAX_CELLS = 4_096
BLOCK = 2_048
REACH = 3.0
ROUNDS = 10


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def fit_centres(sample: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means: unit rows in, unit centres out; starts from k rows spread over the sample."""
    centres = sample[np.linspace(0, len(sample) - 1, k).astype(int)]
    for _ in range(rounds):
        nearest = np.argmax(sample @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        norm = np.linalg.norm(sums, axis=1)
        full = norm > 1e-9
        centres[full] = sums[full] / norm[full, None]
    return centres


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1)


def _assign(centres, threshold: float, reach: float):
    """Home cell and visited cells of unit vectors; columns rep, k, vec, w come in."""

    def run(batches):
        c = centres.value
        dims = c.shape[1] if len(c) else -1
        gaps = np.linalg.norm(c[:, None] - c[None, :], axis=2) if len(c) <= 512 else None
        margin = reach / 2 * np.sqrt(2 - 2 * threshold) / np.sqrt(max(dims, 1))
        for batch in batches:
            sizes = batch.column("dims").to_numpy()
            for d in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == d)))
                x = _unit(_matrix(part.column("vec")))
                if d != dims:
                    home, cells = np.full(len(x), -int(d)), [[]] * len(x)
                else:
                    near = x @ c.T
                    home = np.argmax(near, axis=1)
                    lack = near[np.arange(len(x)), home][:, None] - near
                    gap = gaps[home] if gaps is not None else np.sqrt(np.maximum(2 - 2 * (c[home] @ c.T), 0))
                    visit = (lack <= margin * gap) & (gap > 0)
                    cells = [np.flatnonzero(v).tolist() for v in visit]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("rep"), part.column("k"), part.column("w"), part.column("vec"),
                        pa.array(home, pa.int32()), pa.array(cells, pa.list_(pa.int32())),
                    ],
                    names=["rep", "k", "w", "vec", "home", "visits"],
                )

    return run


def _compare(threshold: float):
    """Counts and links of one pair of blocks; left rows are at home in the cell, right rows are all."""

    def run(key, table):
        cell = key[0].as_py()
        table = table.combine_chunks()
        rep, k = table.column("rep").to_numpy(), table.column("k").to_numpy()
        w, home = table.column("w").to_numpy(), table.column("home").to_numpy()
        x = _unit(_matrix(table.column("vec").chunk(0)))
        left = np.flatnonzero(table.column("left").to_numpy(zero_copy_only=False))
        right = np.flatnonzero(table.column("right").to_numpy(zero_copy_only=False))
        a, b = np.nonzero(x[left] @ x[right].T >= threshold)
        a, b = left[a], right[b]
        inside = home[b] == cell
        keep = inside & (k[a] < k[b])
        if not inside.all():
            # the pair is also seen at home of b if a visits it: count it in the smaller cell
            visits = table.column("visits").chunk(0)
            at = visits.offsets.to_numpy()
            flat = visits.values.to_numpy(zero_copy_only=False).astype(np.int64)
            seen = np.unique((np.repeat(np.arange(len(k)), np.diff(at)) << 32) | flat[at[0] : at[-1]])
            both = np.isin((a << 32) | home[b], seen)
            keep |= ~inside & (~both | (cell < home[b]))
        a, b = a[keep], b[keep]
        count = np.bincount(a, weights=w[b], minlength=len(k)) + np.bincount(b, weights=w[a], minlength=len(k))
        label = rep.copy()
        while True:
            least = label.copy()
            np.minimum.at(least, a, label[b])
            np.minimum.at(least, b, label[a])
            if (least == label).all():
                break
            label = least
        some = np.flatnonzero(count)
        return pa.table({
            "rep": rep[some], "k": k[some], "links": count[some].astype(np.int64), "label": label[some],
        })

    return run


def vector_duplicates(
    vectors: DataFrame,
    threshold: float = 0.9,
    sample: int = SAMPLE,
    cell: int = CELL,
    reach: float = REACH,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per row: ``id``, ``n_links``, ``component_id`` and ``kept``."""
    spark = vectors.sparkSession
    stage = Stage(spark)
    element = vectors.schema[vector_col].dataType.elementType.simpleString()
    vec = F.col(vector_col)
    if element != "float":  # single precision travels as it is and is widened for the products
        element, vec = "double", vec.cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("id"), vec.alias("vec"))
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    length = F.aggregate("vec", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    good = F.coalesce(finite & (length > 0) & (length < float("inf")) & F.col("id").isNotNull(), F.lit(False))
    named = rows.select(
        "id", "vec", good.alias("good"), F.xxhash64("vec").alias("k"), F.xxhash64(F.lit(1), "vec").alias("k2")
    )
    kind = dict(rows.dtypes)["id"]
    named = stage.table(named, "vectors")
    usable = named.where("good")
    classes = usable.groupBy("k", "k2").agg(
        F.min("id").alias("rep"), F.count("*").alias("w"), F.first("vec").alias("vec")
    )
    classes = stage.table(classes.withColumn("dims", F.size("vec")), "classes")

    common = classes.groupBy("dims").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dims").first()
    centres = np.zeros((0, 0))
    if common:
        k = int(min(MAX_CELLS, max(1, -(-common["n"] // cell))))
        drawn = classes.where(F.col("dims") == common["dims"]).orderBy(F.xxhash64("k"), "k2").limit(sample)
        drawn = drawn.select("vec").toArrow().combine_chunks().column("vec")
        points = _unit(_matrix(drawn.chunk(0)))
        centres = fit_centres(points, min(k, len(points)))
    sent = spark.sparkContext.broadcast(centres)
    placed = classes.mapInArrow(
        _assign(sent, threshold, reach),
        f"rep {kind}, k long, w long, vec array<{element}>, home int, visits array<int>",
    )
    placed = stage.table(placed, "placed")

    seats = placed.select(
        "*", F.explode(F.concat(F.array("home"), F.col("visits"))).alias("cell")
    )
    home = F.col("home") == F.col("cell")
    blocks = stage.table(
        seats.groupBy("cell").agg(
            F.ceil(F.count_if(home) / BLOCK).cast("int").alias("rows"),
            F.ceil(F.count("*") / BLOCK).cast("int").alias("columns"),
        ),
        "blocks",
    )
    seats = seats.join(F.broadcast(blocks), "cell")  # one row a cell: at most MAX_CELLS and one a length
    i, j = (F.pmod(F.xxhash64("k"), F.greatest(c, F.lit(1))).cast("int") for c in ("rows", "columns"))
    every = lambda c: F.filter(F.sequence(F.lit(0), F.col(c)), lambda x: x < F.col(c))
    as_left = F.transform(every("columns"), lambda x: F.struct(F.col("a").alias("i"), x.alias("j")))
    as_right = F.transform(every("rows"), lambda x: F.struct(x.alias("i"), F.col("b").alias("j")))
    roles = F.when(home, F.array_union(as_left, as_right)).otherwise(as_right)
    seats = seats.withColumns({"a": i, "b": j}).withColumn("pair", F.explode(roles)).select(
        "cell", "pair.i", "pair.j", "rep", "k", "w", "vec", "home", "visits",
        (home & (F.col("a") == F.col("pair.i"))).alias("left"), (F.col("b") == F.col("pair.j")).alias("right"),
    )
    found = seats.groupBy("cell", "i", "j").applyInArrow(
        _compare(threshold), f"rep {kind}, k long, links long, label {kind}"
    )
    found = stage.table(found, "found")
    counts = found.groupBy("rep", "k").agg(F.sum("links").alias("links"))
    edges = found.where("rep <> label").select(F.col("rep").alias("a"), F.col("label").alias("b")).distinct()
    labels = components(stage, edges)

    owner = stage.table(
        classes.select("k", "k2", "rep", "w").join(counts, ["rep", "k"], "left")
        .join(labels, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("k").alias("o1"), F.col("k2").alias("o2"),
            (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"),
            F.coalesce("label", "rep").alias("component_id"),
        ),
        "owners",
    )
    stage.drop(placed, blocks, found, classes)
    component = F.coalesce("component_id", "id")
    return named.join(
        owner, F.col("good") & (F.col("k") == F.col("o1")) & (F.col("k2") == F.col("o2")), "left"
    ).select(
        "id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"),
    )
