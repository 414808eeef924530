"""Benchmark decontamination: a prefix-filtered join of document words with item-sized windows, JVM only.

Words are stretches of ASCII letters and digits and of non-ASCII characters, A-Z lower-cased. An item's
windows are its stretches of ``window`` words; an item of fewer words, but not none, is one window. A document word is
hit if it lies in an occurrence of a window.

* Order. Words of windows are ordered by how often the documents use them.
* Prefix. Containment of a whole window needs each of its words, so a prefix of one word is enough: a document
  position is a candidate of a window only if it holds the window's rarest word.
* Bounds. The word's place in the window fixes where the occurrence would start and end; both must lie
  in the document.
* Verify. The words there are compared with the window's.

The window table is broadcast only if it is under ``BROADCAST_BYTES``; a larger one is joined by shuffle, and
positions then carry the words around them instead of whole documents. Nulls: a null text has no words, an item
without id is no item, a document without id gets a result of its own. Rows that share id and text
share a result; repeated items count once. Other columns are ignored.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.stage import Stage, keyed, same_row, without

WINDOW = 13
BROADCAST_BYTES = 16 << 20
_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(text: Column) -> Column:
    """Words as they stand, not lower-cased yet."""
    return F.filter(F.split(text, _SEPARATORS), lambda w: F.length(w) > 0)


def item_windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """Columns ``item`` (as a string), ``words`` of one window."""
    words = _words(_lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    known = items.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("item"), words.alias("all")
    )
    length = F.least(F.size("all"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("all") - length + 1)
    return known.where(F.size("all") > 0).select(
        "item", F.explode(F.transform(starts, lambda s: F.slice("all", s, length))).alias("words")
    )


def hits(
    stage: Stage, rows: DataFrame, windows: DataFrame, window: int, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Columns ``id``, ``h``, ``window`` (its words), ``start`` (from 0), ``n``: occurrences of windows in documents."""
    size = windows.agg(F.sum(F.length(F.array_join("words", " ")) + 200)).first()[0] or 0
    small = size <= limit
    fit = F.broadcast if small else lambda df: df

    # order: how often documents use the words of windows
    vocabulary = windows.select(F.explode("words").alias("w")).select(F.lower("w").alias("token")).distinct()
    used = rows.select(F.explode_outer(_words(F.col("text"))).alias("w")).select(F.lower("w").alias("token"))
    counts = stage.table(
        used.join(fit(vocabulary), "token").groupBy("token").agg(F.count("*").alias("uses")), "uses"
    )

    # prefix: the rarest word of each window, its first place on ties; a word that no document uses settles it
    placed = windows.select("window", "words", F.posexplode("words").alias("place", "w"))
    placed = placed.withColumn("token", F.lower("w")).join(counts, "token", "left")
    rank = F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "place", "token")
    prefix = (
        placed.groupBy("window", "words").agg(F.min(rank).alias("r")).where("r.uses > 0")
        .select("window", "words", "r.place", "r.token")
    )
    prefix = stage.table(prefix, "prefix")

    spread = rows.select("id", "h", _words(F.col("text")).alias("said"))
    if small:
        spread = spread.select(
            "id", "h", "said", F.lit(0).alias("cut"), F.size("said").alias("m"),
            F.posexplode_outer("said").alias("at", "w"),
        )
    else:
        cut = F.greatest(F.col("at") - (window - 1), F.lit(0))
        spread = spread.select("id", "h", "said", F.posexplode_outer("said").alias("at", "w")).select(
            "id", "h", F.slice("said", cut + 1, F.lit(2 * window - 1)).alias("said"), cut.alias("cut"),
            F.size("said").alias("m"), "at", "w",
        )
    begin, n = F.col("at") - F.col("place"), F.size("words")
    inside = (F.lower("w") == F.col("token")) & (begin >= 0) & (begin + n <= F.col("m"))
    near = spread.join(fit(prefix), inside)
    # the generator keeps the comparison above the join: only the words of candidates leave the document
    there = F.slice("said", F.greatest(begin - F.col("cut"), F.lit(0)) + 1, n)
    near = near.select(
        "id", "h", "window", "words", begin.alias("start"), n.alias("n"), F.explode(F.array(there)).alias("there")
    )
    found = near.where(F.transform("there", lambda w: _lower(w)) == F.col("words")).select(
        "id", "h", "window", "start", "n"
    )
    found = stage.table(found, "hits")
    stage.drop(counts, prefix)
    return found


def _covered(ranges: Column) -> Column:
    """Positions covered by ranges (start, n), each counted once."""

    def add(state, r):
        end = r["start"] + r["n"]
        return F.struct(
            (state["hit"] + F.greatest(end - F.greatest(r["start"], state["end"]), F.lit(0))).alias("hit"),
            F.greatest(end, state["end"]).alias("end"),
        )

    none = F.struct(F.lit(0).alias("hit"), F.lit(0).alias("end"))
    return F.aggregate(F.array_sort(ranges), none, add, lambda s: s["hit"])


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per row: ``id``, ``h`` (text hash), ``n_words``, ``n_hit``, ``items`` (sorted strings) and ``contaminated``.

    A document is contaminated if windows cover at least a twentieth of its words, and one.
    """
    stage = Stage(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    each = item_windows(items, window, item_col, item_text_col)
    named = F.array_join("words", " ").alias("window")  # words hold no space
    each = stage.table(each.select("item", "words", named).distinct(), "windows")
    windows = stage.table(each.select("window", "words").distinct(), "distinct")
    found = hits(stage, rows, windows, window)
    owner = stage.table(each.select("item", "window"), "owners")
    by_item = (
        found.select("id", "h", "window").distinct().join(owner, "window").groupBy("id", "h")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    by_place = (
        found.groupBy("id", "h", "start").agg(F.max("n").alias("n")).groupBy("id", "h")
        .agg(_covered(F.collect_list(F.struct("start", "n"))).alias("n_hit"))
    )
    told = by_place.join(by_item, same_row(by_place, by_item)).select(
        by_place["id"].alias("key"), by_place["h"].alias("key_h"), "n_hit", "items"
    )
    told = stage.table(told, "told")
    stage.drop(each, windows, found, owner)
    total = F.regexp_count("text", F.lit(_WORD)).cast("long")
    counted = rows.select("id", "h", total.alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return (
        counted.join(told, F.col("id").eqNullSafe(F.col("key")) & (F.col("h") == F.col("key_h")), "left")
        .select(
            "id", "h", "n_words", n_hit.alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        )
    )


def drop_contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings
) -> DataFrame:
    """Rows of documents that are not contaminated, with all their columns."""
    found = contamination(docs, items, id_col=id_col, text_col=text_col, **settings)
    gone = Stage(docs.sparkSession).table(found.where("contaminated").select("id", "h").distinct(), "contaminated")
    return without(docs, gone, id_col, text_col)
