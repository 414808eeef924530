"""Merkle manifest of a table: a leaf per row, a tree per group, a root over the groups, proofs for every row.

A leaf is the SHA-256 of a row's columns (``field``). The leaves of a group ascend by id. Every ``arity`` consecutive
nodes of a level become the SHA-256 of their digests, written as lowercase hex and joined; the last ones of a level
may be fewer, even one. That goes on while a level holds several nodes. The groups' last nodes, ordered by group
(null first, bytewise), are the leaves of one more tree, whose last node is the root.

* Order. Rows are dealt out by ranges of (group, id); a row's number in its group is its place in its range plus
  the sizes of the ranges before. No window spans a group, and rows that tie in everything are split as well.
* Blocks. ``arity ** depth`` neighbouring nodes of a tree, aligned, form one row that keeps each level as one hex
  string; fixed-width substrings of a level hash into the next one. A block's last level is one node of the tree above,
  so blocks are cut into blocks again until every tree is one row: a logarithm of the size to a large base.
* Proofs. What stands before and after a node's substring in its run is a step of its proof. Steps are
  joined on the way down, block to block, where each side has one row per block.

Texts are read once and never shuffled. Null values are ``-`` in a leaf; a null id comes first in its group, a null
group before all. Repeated rows are leaves of their own, next to each other, and which of them stands first makes no
difference. An empty table has no rows and no root. Other columns are ignored, whatever their names.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkloom.llm.stage import Stage

ARITY = 2
DEPTH = 10
_HEX = 64
_STEPS = "array<struct<before:string,after:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else the count of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def numbered(stage: Stage, rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows`` with ``place`` (from 0, by ``order`` inside each ``tree``) and ``size`` (rows of the tree)."""
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(tree, *order, "_tie").sortWithinPartitions(tree, *order, "_tie").drop("_tie")
    dealt = stage.table(dealt.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33).alias("_part")
    parts = dealt.groupBy(tree, part).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    parts = stage.table(parts, "parts")  # a row per range and tree: ranges are contiguous, so few
    whole = Window.partitionBy(tree)
    offsets = parts.select(
        "*",
        (F.sum("_n").over(whole.orderBy("_part")) - F.col("_n")).alias("_before"),
        F.sum("_n").over(whole).alias("size"),
    ).drop("_n")
    offsets = stage.table(offsets, "offsets")
    placed = dealt.withColumn("_part", part).join(offsets, [tree, "_part"])
    place = (F.col("_before") + F.col("_at") - F.col("_first")).alias("place")
    return placed.select(*rows.columns, place, "size")


def _parents(level: Column, arity: int) -> Column:
    """The level above a level, both as the bytes of one hex string."""
    width = arity * _HEX
    runs = F.sequence(F.lit(0), F.ceil(F.length(level) / width).cast("int") - 1)
    digests = F.transform(runs, lambda r: F.sha2(F.substring(level, r * width + 1, F.lit(width)), 256))
    return F.array_join(digests, "").cast("binary")


def _steps(place: Column, levels: Column, arity: int) -> Column:
    """Per level below a block's last one: the digests before and after a node's ancestor in its run."""

    def step(level: Column, k: Column) -> Column:
        at = F.floor(place / F.pow(F.lit(float(arity)), k)).cast("int")
        first = (at - at % arity) * _HEX
        before = F.substring(level, first + 1, (at % arity) * _HEX)
        after = F.substring(level, at * _HEX + _HEX + 1, (arity - 1 - at % arity) * _HEX)
        return F.struct(before.cast("string").alias("before"), after.cast("string").alias("after"))

    return F.transform(F.slice(levels, 1, F.size(levels) - 1), step)


def blocks(nodes: DataFrame, carry: list[str], arity: int, depth: int) -> DataFrame:
    """Rows ``tree``, ``block``, ``size`` (blocks of the tree), ``top``, ``levels`` and ``nodes`` of aligned blocks.

    ``nodes`` needs ``tree``, ``place``, ``size``, ``digest``. A tree of one block ends at its last node; a
    block of a larger tree is hashed through ``depth`` levels, however few nodes it has.
    """
    width = arity**depth
    grouped = nodes.groupBy("tree", F.floor(F.col("place") / width).alias("block")).agg(
        F.max("size").alias("_of"),
        F.array_sort(F.collect_list(F.struct("place", "digest", *carry))).alias("nodes"),
    )
    first = F.array_join(F.col("nodes.digest"), "").cast("binary")
    kept = grouped.withColumn("_level", first)
    n = F.size("nodes")
    # levels up to one node: the smallest k with arity ** k >= n
    powers = F.array(*[F.lit(arity**k) for k in range(depth + 1)])
    alone = F.size(F.filter(powers, lambda p: p < n))
    height = F.when(F.col("_of") > width, depth).otherwise(alone)
    up = F.when(height > 0, F.sequence(F.lit(1), height)).otherwise(F.array().cast("array<int>"))
    levels = F.aggregate(
        up,
        F.array("_level").cast("array<binary>"),
        lambda have, _: F.concat(have, F.array(_parents(F.element_at(have, -1), arity))).cast("array<binary>"),
    )
    made = kept.select(
        "tree", "block", F.ceil(F.col("_of") / width).cast("long").alias("size"), levels.alias("levels"), "nodes"
    )
    return made.withColumn("top", F.element_at("levels", -1).cast("string"))


def _spread(made: DataFrame, above: DataFrame, carry: list[str], arity: int, depth: int) -> DataFrame:
    """Nodes of blocks with their steps to the top, ``above`` holding those of each block (``tree``, ``place``)."""
    over = above.select(
        F.col("tree").alias("_tree"), F.col("place").alias("_place"), F.col("steps").alias("_above"), "subroot", "root"
    )
    met = made.join(over, (F.col("tree") == F.col("_tree")) & (F.col("block") == F.col("_place")))
    base = F.col("block") * arity**depth
    each = F.transform(
        "nodes",
        lambda node: F.struct(
            node.alias("node"),
            F.concat(_steps(node["place"] - base, F.col("levels"), arity), F.col("_above")).cast(_STEPS).alias("steps"),
        ),
    )
    out = met.select("tree", "subroot", "root", F.explode(each).alias("e"))
    return out.select(
        "tree", "subroot", "root", "e.steps", *[F.col(f"e.node.{c}").alias(c) for c in ("place", "digest", *carry)]
    )


def _grown(stage: Stage, nodes: DataFrame, carry: list[str], arity: int, depth: int) -> list[DataFrame]:
    """Blocks of all passes, until every tree is one block."""
    passes = []
    while True:
        made = stage.table(blocks(nodes, carry, arity, depth), "blocks")
        passes.append(made)
        if made.agg(F.max("size")).first()[0] in (None, 1):
            return passes
        nodes, carry = made.select("tree", F.col("block").alias("place"), "size", F.col("top").alias("digest")), []


def proofs(stage: Stage, leaves: DataFrame, arity: int = ARITY, depth: int = DEPTH) -> DataFrame:
    """``leaves`` (``group``, ``id``, ``digest`` and others) with ``subroot``, ``root`` and ``steps`` of every row.

    A step is what stands ``before`` and ``after`` a node in its run, as digests joined.
    """
    carry = [c for c in leaves.columns if c not in ("group", "digest")]
    # a null group is the empty tree name, all others start with a sign: order stays, and joins need no null
    named = leaves.select(F.coalesce(F.concat(F.lit("="), F.col("group")), F.lit("")).alias("tree"), "digest", *carry)
    passes = _grown(stage, numbered(stage, named, "tree", ["id", "digest"]), carry, arity, depth)
    tops = passes[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("top").alias("digest"))
    above = _grown(stage, numbered(stage, tops, "tree", ["name"]), ["name"], arity, depth)

    last = above[-1].select(
        "tree", F.col("block").alias("place"), F.array().cast(_STEPS).alias("steps"), F.lit("").alias("subroot"),
        F.col("top").alias("root"),
    )
    for i in range(len(above) - 1, -1, -1):
        last = stage.table(_spread(above[i], last, ["name"] if i == 0 else [], arity, depth), "steps")
    last = last.select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("place"), "steps", F.col("digest").alias("subroot"), "root"
    )
    for i in range(len(passes) - 1, 0, -1):
        last = stage.table(_spread(passes[i], last, [], arity, depth), "steps")
    return _spread(passes[0], last, carry, arity, depth).drop("tree", "place")


def proof_digest(steps: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(steps, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def manifest(
    docs: DataFrame,
    columns: list[str],
    group_col: str,
    id_col: str = "doc_id",
    tampered: list[Column] | None = None,
    arity: int = ARITY,
    depth: int = DEPTH,
) -> DataFrame:
    """Per row: ``id``, ``leaf``, ``subroot``, ``root``, ``steps``, ``folded_root`` and ``verified``.

    ``columns`` make the leaf, in order. ``tampered`` are values to check against the manifest in their place; null
    for the table itself. ``folded_root`` comes from their leaf and the table's siblings.
    """
    stage = Stage(docs.sparkSession)
    own = [F.col(f"`{c}`") for c in columns]
    leaf = leaf_of(*own)
    claimed = leaf_of(*tampered) if tampered else leaf
    rows = docs.select(
        F.col(f"`{group_col}`").cast("string").alias("group"), F.col(f"`{id_col}`").alias("id"),
        leaf.alias("digest"), claimed.alias("claimed"),
    )
    same = F.when(F.col("claimed") != F.col("digest"), F.col("claimed"))
    found = proofs(stage, rows.withColumn("claimed", same), arity, depth)
    ended = found.withColumn("folded_root", folded(F.coalesce("claimed", "digest"), F.col("steps")))
    return ended.select(
        "id", F.col("digest").alias("leaf"), "subroot", "root", "steps", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
