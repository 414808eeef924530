"""Embedding of chunk texts.

A row is embedded when it is no delete, has text and has no vector yet.  The built-in
embedder is a pure column expression; a model comes in as a callable that is loaded once per
Python worker and is fed Arrow batches.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.functions.text import is_delete, let

BATCH_CHARS = 1 << 20  # characters a model is given at once
OUTAGE = 3  # failed connections in a row after which a task stops asking


def needs_embedding() -> Column:
    return (
        ~is_delete(F.col("action"))
        & (F.col("content") != "")
        & (F.coalesce(F.size("embedding"), F.lit(0)) <= 0)
    )


def hashing_vector(text: Column, dim: int) -> Column:
    """Word counts by hash bucket, scaled to length 1; all zero for a text without words.

    Counting needs no explode: words become odd numbers and one even marker per bucket is
    sorted in between, so the distance between two markers is the count.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    markers = F.sequence(F.lit(0), F.lit(2 * dim), F.lit(2))

    def odd(word):
        number = F.conv(F.substr(F.sha2(word, 256), F.lit(1), F.lit(8)), 16, 10)
        return ((number.cast("long") % dim) * 2 + 1).cast("int")

    def counted(ordered):
        places = F.filter(
            F.transform(ordered, lambda x, i: F.when(x % 2 == 0, i).otherwise(-1)),
            lambda i: i >= 0,
        )
        return let(
            places,
            lambda p: F.zip_with(
                F.slice(p, 2, dim), F.slice(p, 1, dim), lambda after, at: after - at - 1
            ),
        )

    def scaled(counts):
        squares = F.aggregate(counts, F.lit(0).cast("long"), lambda s, c: s + c.cast("long") * c)
        return let(
            F.sqrt(squares),
            lambda norm: F.transform(
                counts, lambda c: F.when(norm > 0, c / norm).otherwise(0.0).cast("float")
            ),
        )

    ordered = F.sort_array(F.concat(F.transform(words, odd), markers))
    return let(let(ordered, counted), scaled)


def embed_by_hashing(rows: DataFrame, dim: int = 1024) -> DataFrame:
    return rows.withColumn(
        "embedding",
        F.when(needs_embedding(), hashing_vector(F.col("content"), dim)).otherwise(
            F.col("embedding")
        ),
    )


def _checked(vectors, count: int, dim: int) -> list[np.ndarray]:
    vectors = [np.asarray(v, dtype=np.float32) for v in vectors]
    if len(vectors) != count:
        raise ValueError(f"embedder returned {len(vectors)} vectors for {count} texts")
    for v in vectors:
        if v.shape != (dim,):
            raise ValueError(f"embedder returned shape {v.shape}, expected ({dim},)")
    return vectors


def _batches(texts: pd.Series, most: int, most_chars: int) -> Iterator[pd.Series]:
    """Texts of like length together, at most so many and so many characters; a longer text comes alone.

    Models pad the texts of a call to the longest, so that even lengths also save work.
    """
    lengths = texts.str.len().to_numpy()
    start, held = 0, 0
    order = np.argsort(lengths, kind="stable")
    for i, at in enumerate(order):
        if i > start and (i - start == most or held + lengths[at] > most_chars):
            yield texts.iloc[order[start:i]]
            start, held = i, 0
        held += lengths[at]
    if len(order):
        yield texts.iloc[order[start:]]


def embed_with_model(
    rows: DataFrame, load: Callable[[], Callable], dim: int, batch_size: int = 64, batch_chars: int = BATCH_CHARS
) -> DataFrame:
    """Embed with ``load()``, a function from a list of texts to as many vectors, in order.

    A call gets at most ``batch_size`` texts and ``batch_chars`` characters, or one text. Adds ``error``: a batch that
    fails is halved until only the texts the model rejects carry an error.  An ``OSError``, as of a
    connection or a timeout, is no fault of a text: the batch carries it as it is, and after
    ``OUTAGE`` of them in a row a task asks no more. The next run takes these files up again.
    Rows that need no vector reach Python as NULL; how many texts come over at once is up to
    ``spark.sql.execution.arrow.maxRecordsPerBatch``.
    """

    @F.pandas_udf("vector array<float>, error string")
    def infer(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model, outages = load(), []

        def failed(texts, error):
            return [(None, f"{type(error).__name__}: {error}")] * len(texts)

        def attempt(texts):
            if len(outages) >= OUTAGE:
                return failed(texts, outages[-1])
            try:
                vectors = _checked(model(texts), len(texts), dim)
            except OSError as e:
                outages.append(e)
                return failed(texts, e)
            except Exception as e:
                outages.clear()
                half = len(texts) // 2
                return attempt(texts[:half]) + attempt(texts[half:]) if half else failed(texts, e)
            outages.clear()
            return [(v, None) for v in vectors]

        for batch in batches:
            texts = batch.reset_index(drop=True)
            vectors, errors = [None] * len(texts), [None] * len(texts)
            for part in _batches(texts[texts.notna()], batch_size, batch_chars):
                for at, (vector, error) in zip(part.index, attempt(part.tolist()), strict=True):
                    vectors[at], errors[at] = vector, error
            yield pd.DataFrame(
                {"vector": pd.Series(vectors, dtype=object), "error": pd.Series(errors, dtype=object)}
            )

    result = rows.withColumn("_m", infer(F.when(needs_embedding(), F.col("content"))))
    earlier = F.col("error") if "error" in rows.columns else F.lit(None).cast("string")
    return (
        result.withColumn("embedding", F.coalesce(F.col("_m.vector"), F.col("embedding")))
        .withColumn("error", F.coalesce(earlier, F.col("_m.error")))
        .drop("_m")
    )


def embedder(kind="hashing", dim: int = 1024, batch_size: int = 64) -> Callable:
    """A ``DataFrame -> DataFrame`` step: ``"hashing"`` or a model loader."""
    if callable(kind):
        return lambda rows: embed_with_model(rows, kind, dim, batch_size)
    if kind == "hashing":
        return lambda rows: embed_by_hashing(rows, dim)
    raise ValueError(f"embedding must be 'hashing' or a callable, not {kind!r}")
