"""Toxicity: class-conditional Kneser-Ney models of byte grams with shared backoff counts.

Two interpolated models, toxic and ordinary, predict each byte of a lower-cased text from the bytes before it. Grams of
five bytes are counted for each class. What their discount leaves goes to grams of three, these leave to grams of
two, and these to single bytes. As Kneser and Ney have it, a shorter gram is not counted by its uses but by
its continuations: the number of distinct longer grams that end with it, in both classes together. So the lower orders are
shared, and a rare expression that neither class can judge favours none. Every level leaves to the one below the
discount times the number of distinct bytes seen after the context.

A text is compared by its two log-likelihoods, each divided by the length: over the whole text, and over the window
of ``WINDOW`` bytes where they differ most, because a long text can be toxic in one line. A logistic curve over both
and the logarithm of the length, fitted on labelled documents held back from counting, makes the score.

Grams and contexts are counted in hashed slots, so the model has a fixed size (some 50 MB) whatever the
corpus, and that is what is broadcast. Counting covers every labelled training document and grows with the
input; the curve is fitted on at most ``calibration_rows`` documents.

Only labels of documents with ``crc32(id) mod 5 <> 0`` are read: remainders 1 to 3 count, 4 calibrates. Ids
and labels choose those rows and are no input of a score. An empty or null text has statistic 0 and
length 0. Null labels are not read; a document with several labels counts as toxic if one says so.
Without training labels of both classes every score is 0. Repeated rows are scored alike.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.llm.numeric import U, bytes_sequence, lower_bytes, mix, text_blocks
from chunkloom.llm.stage import Stage

CALIBRATION_ROWS = 50_000
BROADCAST_LABELS = 2_000_000
WINDOW = 12
DISCOUNT = 0.75
ORDERS = (2, 3, 5)
GRAM_BITS = (16, 20, 22)
CONTEXT_BITS = (12, 18, 20)


def _slots(buf: np.ndarray, begin: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the context before each byte and of the gram that ends with it, inside its text."""
    sequence = bytes_sequence(buf, 0)
    at = np.arange(len(buf))
    start = np.maximum(at + 1 - ORDERS[level], begin)
    gram = sequence.hashes(start, at + 1) >> U(64 - GRAM_BITS[level])
    context = mix(sequence.hashes(start, at) + U(1)) >> U(64 - CONTEXT_BITS[level])
    return context.astype(np.int64), gram.astype(np.int64)


def _lowered(buf: np.ndarray, offsets: np.ndarray):
    """Lower-cased bytes, text number and first position of the text for every byte."""
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    return lower_bytes(buf), text, offsets[:-1][text]


def _counts(batches):
    """Distinct grams of the highest order with the shorter grams they end with, counted by class.

    ``key`` holds context and gram of the highest order, ``mid`` and ``low`` those of the levels below.
    """
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
        for first, _, buf, offsets in text_blocks(batch.column("text")):
            if not len(buf):
                continue
            buf, text, begin = _lowered(buf, offsets)
            label = toxic[first + text]
            low, mid, key = (
                context << GRAM_BITS[level] | gram
                for level in range(len(ORDERS))
                for context, gram in (_slots(buf, begin, level),)
            )
            low = low << 8 | buf
            whole = mix(mix(mix(key.astype(U)) ^ mid.astype(U)) ^ low.astype(U)) << U(1) | label.astype(U)
            _, at, n = np.unique(whole, return_index=True, return_counts=True)
            label = label[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[at]), pa.array(mid[at]), pa.array(low[at]), pa.array(n * (1 - label)), pa.array(n * label)],
                names=["key", "mid", "low", "n0", "n1"],
            )


@dataclass
class Level:
    """One order: discounted counts of grams, one over the count of contexts, and what contexts leave below."""

    gram: np.ndarray
    inverse: np.ndarray
    left: np.ndarray

    def mixed(self, context: np.ndarray, gram: np.ndarray, below: np.ndarray) -> np.ndarray:
        return self.gram[gram] * self.inverse[context] + self.left[context] * below


def _level(gram: np.ndarray, total: np.ndarray, distinct: np.ndarray) -> Level:
    left = np.where(total > 0, DISCOUNT * distinct / np.maximum(total, 1), 1.0)
    each = (np.maximum(gram - DISCOUNT, 0), 1 / np.maximum(total, 1), left)
    return Level(*[x.astype(np.float32) for x in each])


@dataclass
class Model:
    base: np.ndarray  # (256,) probabilities of bytes
    shared: list[Level]  # by continuations, from the lowest order
    classes: list[Level]  # highest order, ordinary and toxic
    weights: np.ndarray | None = None  # of the logistic curve

    def log_likelihoods(self, buf: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
        """Of every byte in the ordinary and the toxic model."""
        p = self.base[buf]
        for level, order in enumerate(self.shared):
            p = order.mixed(*_slots(buf, begin, level), p)
        context, gram = _slots(buf, begin, len(ORDERS) - 1)
        return [np.log(order.mixed(context, gram, p), dtype=np.float64) for order in self.classes]

    def statistic(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: number of bytes, difference of mean log-likelihoods in the best window and in the whole."""
        m, n = len(offsets) - 1, np.diff(offsets)
        if not len(buf):
            return n, np.zeros(m), np.zeros(m)
        buf, _, begin = _lowered(buf, offsets)
        ordinary, toxic = self.log_likelihoods(buf, begin)
        sums = np.concatenate(([0.0], np.cumsum(toxic - ordinary)))
        end = np.arange(1, len(buf) + 1)
        mean = (sums[end] - sums[np.maximum(end - WINDOW, begin)]) / WINDOW
        best = np.zeros(m)
        full = np.flatnonzero(n)
        best[full] = np.maximum.reduceat(mean, offsets[full])
        return n, best, (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(n, 1)

    def scores(self, n: np.ndarray, x: np.ndarray, whole: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(x))
        return 1 / (1 + np.exp(-np.clip(features(n, x, whole) @ self.weights, -50, 50)))


def features(n: np.ndarray, x: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The best of many windows grows with the logarithm of their number."""
    return np.column_stack((np.ones(len(x)), x, whole, np.log1p(n)))


def _table(df: DataFrame, size: int, *names: str) -> np.ndarray:
    rows = df.toArrow()
    at = rows.column("slot").to_numpy()
    out = np.zeros((len(names), size))
    for i, name in enumerate(names):
        out[i, at] = rows.column(name).to_numpy()
    return out


def count_model(stage: Stage, labelled: DataFrame) -> Model | None:
    """Both models from columns ``text`` and ``toxic``. The driver gets one row per slot at most."""
    keys = ["key", "mid", "low"]
    counted = labelled.mapInArrow(_counts, "key long, mid long, low long, n0 long, n1 long")
    counted = stage.table(
        counted.groupBy(*keys).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "grams"
    )
    total = [F.sum(f"n{c}").alias(f"n{c}") for c in (0, 1)]
    uses = counted.agg(*total).first()
    model = None
    if uses["n0"] and uses["n1"]:
        top = len(ORDERS) - 1
        distinct = [F.count_if(F.col(f"n{c}") > 0).alias(f"k{c}") for c in (0, 1)]
        n = _table(counted.groupBy(_low_bits("key", GRAM_BITS[top])).agg(*total), 1 << GRAM_BITS[top], "n0", "n1")
        c = _table(
            counted.groupBy(_high_bits("key", GRAM_BITS[top])).agg(*total, *distinct), 1 << CONTEXT_BITS[top],
            "n0", "n1", "k0", "k1",
        )
        classes = [_level(n[i], c[i], c[2 + i]) for i in (0, 1)]
        # continuations: distinct longer grams that end with a shorter one
        middle = counted.groupBy("mid", "low").agg(F.count("*").alias("n"))
        lowest = stage.table(middle.groupBy("low").agg(F.count("*").alias("n")), "continuations")
        pairs = lowest.select(F.shiftright("low", 8).alias("low"), "n")
        shared = [_shared(pairs, "low", 0), _shared(middle, "mid", 1)]
        bytes_ = _table(lowest.groupBy(_low_bits("low", 8)).agg(F.count("*").alias("n")), 256, "n")[0] + 0.5
        model = Model((bytes_ / bytes_.sum()).astype(np.float32), shared, classes)
        stage.drop(lowest)
    stage.drop(counted)
    return model


def _low_bits(name: str, bits: int) -> Column:
    return F.col(name).bitwiseAND((1 << bits) - 1).cast("int").alias("slot")


def _high_bits(name: str, bits: int) -> Column:
    return F.shiftright(name, bits).cast("int").alias("slot")


def _shared(grams: DataFrame, name: str, level: int) -> Level:
    """A lower order from its grams and their numbers of continuations ``n``."""
    total, bits = F.sum("n").alias("n"), GRAM_BITS[level]
    n = _table(grams.groupBy(_low_bits(name, bits)).agg(total), 1 << bits, "n")
    after = F.count_distinct(name).alias("k")
    c = _table(grams.groupBy(_high_bits(name, bits)).agg(total, after), 1 << CONTEXT_BITS[level], "n", "k")
    return _level(n[0], c[0], c[1])


def fit_curve(a: np.ndarray, label: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge."""
    y = label.astype(float)
    scale = np.maximum(np.abs(a).max(axis=0), 1e-12)
    a = a / scale
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -50, 50)))
        hessian = (a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(a.shape[1])
        step = np.linalg.solve(hessian, a.T @ (y - p) - 1e-3 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w / scale


def _statistics(model):
    def run(batches):
        for batch in batches:
            for first, last, buf, offsets in text_blocks(batch.column("text")):
                n, x, whole = model.value.statistic(buf, offsets)
                rest = [batch.column(c).slice(first, last - first) for c in batch.schema.names if c != "text"]
                names = [c for c in batch.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(n), pa.array(x), pa.array(whole)], names=[*names, "n", "x", "whole"]
                )

    return run


def fold(key: Column) -> Column:
    """Remainder that decides what a label is used for; null keys take part in nothing but scoring."""
    return F.crc32(key.cast("string")) % 5


def fit(
    docs: DataFrame,
    labels: DataFrame,
    calibration_rows: int = CALIBRATION_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model | None:
    stage = Stage(docs.sparkSession)
    toxic = (
        labels.where(F.col(label_col).isNotNull() & (fold(F.col(id_col)) != 0))
        .groupBy(F.col(id_col).alias("key"))
        .agg(F.max((F.col(label_col) == 1).cast("int")).alias("toxic"))
    )
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    narrow = docs.select(F.col(id_col).alias("id"), text)
    toxic = stage.table(toxic, "labels")
    if toxic.count() <= BROADCAST_LABELS:
        toxic = F.broadcast(toxic)  # two numbers a row: some 64 MB at most; more are joined by shuffle
    labelled = narrow.join(toxic, narrow["id"] == toxic["key"])
    model = count_model(stage, labelled.where(fold(F.col("id")) != 4).select("text", "toxic"))
    if model is None:
        return None
    sent = docs.sparkSession.sparkContext.broadcast(model)
    held = labelled.where(fold(F.col("id")) == 4).select("text", "toxic")
    found = (
        held.withColumn("order", F.xxhash64("text"))
        .select("order", "toxic", "text")
        .mapInArrow(_statistics(sent), "order long, toxic int, n long, x double, whole double")
        .orderBy("order", "toxic", "n", "x", "whole")
        .limit(calibration_rows)
        .toArrow()
    )
    y = found.column("toxic").to_numpy()
    if len(y) and y.min() != y.max():
        model.weights = fit_curve(features(*[found.column(c).to_numpy() for c in ("n", "x", "whole")]), y)
    else:
        model.weights = np.array([-6.0, 6.0, 0.0, 0.0])
    sent.destroy()
    return model


def score_of(spark: SparkSession, model: Model | None, text: Column) -> Column:
    """Score of a text column, 0 to 1."""
    if model is None:
        return F.lit(0.0)
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        parts = [
            sent.value.scores(*sent.value.statistic(buf, offsets))
            for _, _, buf, offsets in text_blocks(column)
        ]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score(F.coalesce(text.cast("string"), F.lit("")))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows of documents with a score below the threshold, with all their columns.

    Null and empty texts are scored by their length alone; repeated rows go or stay together.
    """
    score = score_of(docs.sparkSession, fit(docs, labels), F.col("text"))
    return docs.where(score < threshold)
