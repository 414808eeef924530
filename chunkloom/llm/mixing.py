"""Mixing sources to target weights by entropy balancing.

The size of a document is its number of words. Sources, in order of code points with null last, weigh
``weights`` in turn and share ``total`` times all sizes; no target exceeds ``most`` times its source's size, and the
excess is shared again by weight until none does (a level found from sorted ratios, in one pass).

Rates. Of all document rates with the targets' word totals, entropy balancing takes the one nearest to the
uniform rate ``total``. The dual has one number per source, and the solution is an exponential tilt of the size,
``min(most, total * exp(lambda * size / mean))``. All duals are found at once by Newton steps kept inside a
shrinking bracket, each step one aggregation over the histogram of (source, size).

Copies. Each histogram cell rounds its documents' rates to a whole number of copies, half up; what a
source then lacks or has too much is settled cell by cell, the largest that fits first, until no single copy can
bring it nearer. Inside a cell, copies go to documents in the order of a hash of id and text, ranked in small groups
so that a cell of any size is split. Reruns agree, no document is taken more than ``most`` times.

Nulls: a null text has size 0, a null source is a source of its own. Documents of size 0 are kept once and take
nothing. Rows that repeat id and text share the hash, and get copies in any order among themselves.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkloom.llm.stage import Stage, keyed

WEIGHTS = (3, 1, 2)
TOTAL = 1.5
MOST = 2
GROUP = 128
_WORD = r"[^\x20\x09-\x0D]+"
_STEPS = 60


def targets(sizes: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: int = MOST) -> DataFrame:
    """``source``, ``source_size``, ``n`` and ``target`` from rows of ``source``, ``size``, ``n`` documents."""
    sources = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), place % len(weights))
    sources = sources.withColumn("weight", weight).withColumn("cap", most * F.col("source_size").cast("double"))
    # sources reach their cap in the order of cap / weight; the level is that of the first that does not
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    words = total * F.sum("source_size").over(everything)
    level = (words - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    sources = sources.withColumn("level", level)
    # from the first uncapped source on, all take its level
    first = F.min(
        F.when(F.col("cap") > F.col("level") * F.col("weight"), F.struct(F.col("cap") / F.col("weight"), "level"))
    ).over(everything)
    share = F.coalesce(first["level"] * F.col("weight"), F.col("cap"))
    return sources.select("source", "source_size", "n", F.least("cap", share).alias("target"))


def _rate(size: Column, mean: Column, dual: Column, total: float, most: int) -> Column:
    return F.least(F.lit(float(most)), total * F.exp(F.least(dual * size / mean, F.lit(50.0))))


def _same_source(left: DataFrame, right: DataFrame) -> Column:
    return left["source"].eqNullSafe(right["source"])


def rates(stage: Stage, cells: DataFrame, sources: DataFrame, total: float, most: int) -> DataFrame:
    """Cells with the rate of their documents."""
    state = sources.select(
        "source", "target", (F.col("source_size") / F.greatest("n", F.lit(1))).alias("mean"),
        (F.col("target") >= most * F.col("source_size")).alias("all"),
        F.lit(-200.0).alias("low"), F.lit(200.0).alias("high"), F.lit(0.0).alias("dual"),
    )
    state = stage.table(state.withColumn("mean", F.greatest("mean", F.lit(1e-9))), "duals")
    filled = cells.where("size > 0")
    for _ in range(_STEPS):
        joined = filled.join(state, _same_source(filled, state)).select(filled["*"], *[state[c] for c in ("mean", "dual")])
        x = F.col("size") / F.col("mean")
        rate = _rate(F.col("size"), F.col("mean"), F.col("dual"), total, most)
        mass = F.col("n") * F.col("size") * rate
        sums = joined.groupBy("source").agg(
            F.sum(mass).alias("sum"), F.sum(F.when(rate < most, mass * x).otherwise(0.0)).alias("slope")
        )
        miss = F.col("sum") - F.col("target")
        low = F.when(miss < 0, F.col("dual")).otherwise(F.col("low"))
        high = F.when(miss > 0, F.col("dual")).otherwise(F.col("high"))
        newton = F.col("dual") - miss / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > low) & (newton < high)
        done = F.col("all") | (F.abs(miss) < 0.25) | miss.isNull()
        step = F.when(done, F.col("dual")).when(inside, newton).otherwise((low + high) / 2)
        after = state.join(sums, _same_source(state, sums), "left").select(
            state["source"], "target", "mean", "all", low.alias("low"), high.alias("high"), step.alias("dual"),
            done.alias("done"),
        )
        before, after = state, stage.table(after, "duals")
        stage.drop(before)
        state = after.drop("done")
        if after.agg(F.bool_and("done")).first()[0] in (True, None):
            break
    rate = F.when(F.col("all"), F.lit(float(most))).otherwise(
        _rate(F.col("size"), F.col("mean"), F.col("dual"), total, most)
    )
    return cells.join(state, _same_source(cells, state)).select(cells["*"], rate.alias("rate"))


def whole_copies(stage: Stage, cells: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """Cells with the number of copies of all their documents together."""
    half_up = F.least(F.floor(F.col("n") * F.col("rate") + 0.5), most * F.col("n"))
    cells = cells.withColumn("copies", F.when(F.col("size") == 0, F.col("n")).otherwise(half_up))
    cells = stage.table(cells.select("source", "size", "n", "copies"), "copies")
    goal = sources.select("source", "target")
    for _ in range(_STEPS):
        taken = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"))
        lack = goal.join(taken, _same_source(goal, taken)).select(
            goal["source"], (F.col("target") - F.col("taken")).alias("lack")
        )
        lack = stage.table(lack, "lack")
        filled = cells.where("size > 0")
        # moving m copies of a cell helps while m * size stays below twice what is lacking
        near = F.abs("lack")
        room = F.when(F.col("lack") > 0, most * F.col("n") - F.col("copies")).otherwise(F.col("copies"))
        fits = filled.join(lack, _same_source(filled, lack)).where((room > 0) & (F.col("size") < 2 * near)).select(
            filled["source"], "size", "lack", room.alias("room")
        )
        best = fits.groupBy("source").agg(F.max(F.struct(F.least("size", near).alias("s"), -F.col("size"), "size", "room", "lack")).alias("r"))
        moves = F.greatest(F.lit(1), F.least(F.col("r.room"), F.floor(F.abs("r.lack") / F.col("r.size"))))
        moved = best.select("source", "r.size", (F.signum("r.lack") * moves).cast("long").alias("move"))
        moved = stage.table(moved, "moves")
        if moved.isEmpty():
            stage.drop(lack, moved)
            break
        after = cells.join(moved, _same_source(cells, moved) & (cells["size"] == moved["size"]), "left").select(
            *[cells[c] for c in ("source", "size", "n")],
            (F.col("copies") + F.coalesce("move", F.lit(0))).alias("copies"),
        )
        before, cells = cells, stage.table(after, "copies")
        stage.drop(before, lack, moved)
    return cells


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    total: float = TOTAL,
    most: int = MOST,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Per row: ``id``, ``h``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken``."""
    stage = Stage(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias("size"),
    )
    rows = stage.table(rows, "sizes")
    cells = stage.table(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "cells")
    sources = stage.table(targets(cells, weights, total, most), "sources")
    rated = stage.table(rates(stage, cells, sources, total, most), "rates")
    copies = whole_copies(stage, rated, sources, most)

    # copies of a cell go to its documents in hash order, by way of groups of about GROUP documents
    order = F.xxhash64("id", "h")
    wide = copies.select(
        "source", "size", "copies", F.col("n").alias("cell_n"),
        F.greatest(F.lit(1), F.ceil(F.col("n") / GROUP)).alias("groups"),
    )
    dealt = rows.join(wide, _same_source(rows, wide) & (rows["size"] == wide["size"])).select(
        rows["*"], "copies", "cell_n", order.alias("order"), F.pmod(F.xxhash64(order, F.lit(7)), "groups").alias("g")
    )
    dealt = stage.table(dealt, "dealt")
    cell = Window.partitionBy("source", "size").orderBy("g")
    until = F.sum("k").over(cell)
    share = lambda k: F.floor(F.col("copies") * k / F.col("cell_n"))
    groups = dealt.groupBy("source", "size", "g", "copies", "cell_n").agg(F.count("*").alias("k"))
    groups = groups.withColumn("until", until).select(
        "source", "size", "g", "k", (share(F.col("until")) - share(F.col("until") - F.col("k"))).alias("part")
    )
    groups = stage.table(groups, "groups")
    rank = F.row_number().over(Window.partitionBy("source", "size", "g").orderBy("order", "id")) - 1
    mine = groups["source"].eqNullSafe(dealt["source"]) & (groups["size"] == dealt["size"]) & (groups["g"] == dealt["g"])
    ranked = dealt.withColumn("rank", rank)
    given = ranked.join(groups, mine).select(
        "id", "h", dealt["source"], dealt["size"],
        (F.floor(F.col("part") / F.col("k")) + (F.col("rank") < F.col("part") % F.col("k")).cast("long")).alias("copies"),
    )
    known = sources.select(F.col("source").alias("of"), "source_size", "target")
    stage.drop(rated, cells)
    return given.join(known, F.col("source").eqNullSafe(F.col("of"))).select(
        "id", "h", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", copy_col: str = "copy", **settings
) -> DataFrame:
    """Each row as often as the mix takes it, with all its columns and the number of the copy, from 1.

    A column of that name gives way. Of rows that repeat id and text each gets copies of its own.
    """
    stage = Stage(docs.sparkSession)
    dealt = mix(docs, id_col=id_col, text_col=text_col, **settings)
    twin = Window.partitionBy("id", "h")
    dealt = dealt.select(
        F.col("id").alias("key"), F.col("h").alias("key_h"), "copies",
        F.row_number().over(twin.orderBy(F.desc("copies"))).alias("key_twin"),
    )
    dealt = stage.table(dealt.where("copies > 0"), "dealt")
    rows = keyed(docs.drop(copy_col), id_col, text_col, keep_row=True).drop("text")
    rows = rows.withColumn("twin", F.row_number().over(twin.orderBy(F.lit(0))))
    same = F.col("id").eqNullSafe(F.col("key")) & (F.col("h") == F.col("key_h")) & (F.col("twin") == F.col("key_twin"))
    number = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias(copy_col)
    return rows.join(dealt, same).select("row", number).select("row.*", copy_col)
