"""Dropping of unchanged records by content hash.

Two forms.  `changed_files` compares one scan, in which a path occurs once, with the stored
snapshot.  `passing_versions` reads a log in which a path occurs many times: a record passes
when its hash differs from that of the previous record of its path, and the snapshot stands
before the first.  Both work on narrow key-and-hash rows; file texts are fetched afterwards
for the rows that pass.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkloom.functions.text import is_delete

PATH = ["workspace_id", "path"]
# Versions of one path are split into ranges of this many sequence numbers, so that a path
# with a large share of the log is spread over many tasks.
SEQ_BLOCK = 1_000_000
_FIRST_BLOCK = -(1 << 62)
_MOST_BLOCKS = 10_000


def null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """A join on columns of one name in which nulls meet nulls; those of ``right`` are left out."""
    there = right.withColumnsRenamed({c: f"_on_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on]
    joined = left.join(there, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_on_{c}" for c in on])


def differs(stored: Column, current: Column) -> Column:
    return ~stored.eqNullSafe(current)


def changed_files(files: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Rows of one scan whose hash is new or different.  Deletes pass."""
    stored = snapshot.select(*PATH, F.col("content_hash").alias("stored_hash"))
    return (
        files.join(stored, PATH, "left")
        .where(is_delete(F.col("action")) | differs(F.col("stored_hash"), F.col("content_hash")))
        .drop("stored_hash")
    )


def hot_paths(log: DataFrame, seq_block: int = SEQ_BLOCK) -> DataFrame:
    """Paths with more versions than one block should hold, and their ``count``; at most rows / block of them."""
    return log.groupBy(*PATH).count().where(F.col("count") > seq_block).select(*PATH, "count")


def hot_cuts(log: DataFrame, hot: DataFrame, seq_block: int = SEQ_BLOCK) -> DataFrame:
    """``hot`` with ``cuts``: the numbers that part a path's versions into blocks of about ``seq_block`` rows.

    The cuts are quantiles, so numbers may be as sparse or uneven as clocks make them. Each map task sends one sketch per
    hot path. The cuts of a path are grouped, to find a number's block in two short searches.
    """
    most = hot.agg(F.max("count")).first()[0]
    blocks = min(math.ceil((most or 1) / seq_block), _MOST_BLOCKS)
    if blocks < 2:
        return hot.select(*PATH, F.array().cast("array<array<bigint>>").alias("cuts"))
    shares = [i / blocks for i in range(1, blocks)]
    narrow = null_safe(log.where("seq IS NOT NULL").select(*PATH, "seq"), hot.select(*PATH), PATH, "left_semi")
    cut = F.percentile_approx("seq", shares, 10 * blocks)
    each = narrow.groupBy(*PATH).agg(F.array_sort(F.array_distinct(cut)).alias("all"))
    wide = math.isqrt(blocks) + 1
    groups = F.transform(
        F.sequence(F.lit(1), F.size("all"), F.lit(wide)), lambda i: F.slice("all", i, F.lit(wide))
    )
    return each.select(*PATH, groups.alias("cuts"))


def _block_of(seq: Column, cuts: Column) -> Column:
    """How many cuts are below a number; its place in the order of blocks."""
    before = F.size(F.filter(cuts, lambda group: F.element_at(group, -1) < seq))
    inside = F.coalesce(F.size(F.filter(F.get(cuts, before), lambda c: c < seq)), F.lit(0))
    width = F.coalesce(F.size(F.get(cuts, F.lit(0))), F.lit(0))
    return (before * width + F.greatest(inside, F.lit(0))).cast("long")


def passing_versions(
    log: DataFrame,
    snapshot: DataFrame | None = None,
    *,
    hot: DataFrame | None = None,
    carry: tuple[str, ...] = (),
    deletes_reset: bool = True,
    seq_block: int = SEQ_BLOCK,
) -> DataFrame:
    """``(workspace_id, path, seq, *carry)`` of the log rows that pass.

    ``log`` needs workspace_id, path, seq, action and content_hash, with (path, seq) unique.
    With ``deletes_reset`` a delete forgets the remembered hash; without it deletes are
    ignored, so re-adding identical content after a delete is dropped.

    Each (path, block) is compared by itself.  Only the last hash of a block is handed to the
    next one, and that hand-over is computed from one narrow row per path and block.  With
    ``hot``, staged so that its small size is known, only those paths are cut into blocks and
    the hand-over shrinks to one row for every other path; ``hot_cuts`` gives it cuts, without
    which blocks have a fixed width.  Rows without workspace or path are not compared and do not pass.
    """
    # A row without a number comes before all others of its path.
    block = F.expr(f"seq div {int(seq_block)}")
    if hot is not None:
        has_cuts = "cuts" in hot.columns
        block = _block_of(F.col("seq"), F.col("cuts")) if has_cuts else block
        hot = hot.select(*PATH, F.lit(True).alias("is_hot"), *(["cuts"] if has_cuts else []))
        log = log.join(hot, PATH, "left")
    block = F.coalesce(F.when(F.col("seq").isNotNull(), block), F.lit(_FIRST_BLOCK))
    if hot is not None:
        block = F.when(F.col("is_hot"), block).otherwise(0)
    # A delete has no hash.  Both uses of `rows` need the same columns and the same non-null
    # keys, which the join below would ask of one of them only, so they share one shuffle.
    rows = log.select(
        *PATH,
        "seq",
        F.when(~is_delete(F.col("action")), F.col("content_hash")).alias("hash"),
        block.alias("block"),
        *carry,
    ).where("workspace_id IS NOT NULL AND path IS NOT NULL")
    compared = rows if deletes_reset else rows.where("hash IS NOT NULL")

    in_block = Window.partitionBy(*PATH, "block").orderBy("seq")
    within = compared.select(
        "*",
        F.lag("hash").over(in_block).alias("previous"),
        F.lag(F.lit(1)).over(in_block).isNull().alias("first"),
        F.lead(F.lit(1)).over(in_block).isNull().alias("last"),
    )
    by_path = Window.partitionBy(*PATH).orderBy("block")
    ends = within.where("last").select(
        *PATH,
        "block",
        F.lag("hash").over(by_path).alias("handed"),
        F.lag("block").over(by_path).isNull().alias("first_block"),
    )
    if snapshot is not None:
        # Only the snapshot rows of paths in this log matter; both joins are narrow.
        paths = compared.select(*PATH).distinct()
        stored = snapshot.join(paths, PATH, "left_semi").select(
            *PATH, F.col("content_hash").alias("stored")
        )
        ends = ends.join(stored, PATH, "left").withColumn(
            "handed", F.when(F.col("first_block"), F.col("stored")).otherwise(F.col("handed"))
        )
    carried = ends.select(*PATH, "block", F.col("handed").alias("carried")).where(
        "carried IS NOT NULL AND block IS NOT NULL"
    )

    previous = F.when(F.col("first"), F.col("carried")).otherwise(F.col("previous"))
    passing = (
        within.join(carried, [*PATH, "block"], "left")
        .where(F.col("hash").isNull() | differs(previous, F.col("hash")))
        .select(*PATH, "seq", *carry)
    )
    if deletes_reset:
        return passing
    return passing.unionByName(rows.where("hash IS NULL").select(*PATH, "seq", *carry))


def drop_unchanged(
    log: DataFrame,
    snapshot: DataFrame | None = None,
    *,
    hot: DataFrame | None = None,
    deletes_reset: bool = True,
    seq_block: int = SEQ_BLOCK,
) -> DataFrame:
    """The log rows that pass, with all their columns.

    Narrow rows go through the comparison whole.  Texts do not: they are joined to the
    passing keys afterwards.
    """
    options = {"hot": hot, "deletes_reset": deletes_reset, "seq_block": seq_block}
    key = [*PATH, "seq"]
    if "content" not in log.columns:
        carry = tuple(c for c in log.columns if c not in key)
        return passing_versions(log, snapshot, carry=carry, **options).select(*log.columns)
    passing = passing_versions(log, snapshot, **options)
    same = [log[c] == passing[c] for c in PATH] + [log["seq"].eqNullSafe(passing["seq"])]
    return log.join(passing, same, "left_semi")
