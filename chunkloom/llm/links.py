"""Connected components of a table of links, without any node's links in one task."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.stage import Stage


def _to_least(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over links ``(u, v)`` with u > v.

    Large star: the larger neighbours of a node move to the least node around it. Small star: the smaller
    ones do, and the node itself.
    """

    def turned(u: str, v: str):
        return F.struct(F.col(u).alias("u"), F.col(v).alias("v"))

    # Both directions come from one generator: no grouping here reads a union.
    if large:
        both = edges.select(F.inline(F.array(turned("u", "v"), turned("v", "u"))))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        placed = edges.join(least, "u")
        moved = placed.select(F.inline(F.array(turned("v", "m"), turned("u", "m")))).where("u <> v")
    return moved.distinct()


def components(stage: Stage, links: DataFrame) -> DataFrame:
    """Columns ``node`` and ``label`` (least node reachable) for every node that is not its own label.

    Alternates large and small stars (Kiveris and others, 2014) on links ``(a, b)`` until nothing moves:
    a number of rounds of the order of the logarithm of the size, each a few shuffles of narrow rows.
    """
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    edges = stage.table(edges.distinct(), "links")
    state = None
    while True:
        mark = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
        ).first()
        if mark == state or not mark["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        state, before = mark, edges
        wide = stage.table(_to_least(edges, large=True), "large")
        edges = stage.table(_to_least(wide, large=False), "small")
        stage.drop(before, wide)
