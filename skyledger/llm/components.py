"""Connected components of a stored list of links, by rounds of contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.base import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, comp)`` for every node of a link; ``comp`` is one of the component's nodes.

    Each round moves every node to its least neighbour, itself included, in an order drawn anew for the round, so
    chains shrink by a constant share. Links and the map from nodes are written tables; the driver sees counts only.
    """
    edges = stored(links.filter(F.col(a) != F.col(b)).select(F.col(a).alias("u"), F.col(b).alias("v")).distinct(), "links")
    mapping, turn = None, 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rank = lambda c: F.xxhash64(c, F.lit(turn))
        least = both.groupBy("u").agg(F.min(F.struct(rank("v").alias("r"), F.col("v").alias("to"))).alias("m"))
        moved = stored(
            least.select(
                F.col("u").alias("old"),
                F.when(F.struct(rank("u").alias("r"), F.col("u").alias("to")) < F.col("m"), F.col("u")).otherwise(F.col("m.to")).alias("new"),
            ),
            "moved",
        )
        if mapping is None:
            mapping = moved.select(F.col("old").alias("node"), F.col("new").alias("comp"))
        else:
            mapping = stored(
                mapping.join(moved, mapping.comp == moved.old, "left").select("node", F.coalesce("new", "comp").alias("comp")), "mapping"
            )
        at_u = moved.select(F.col("old").alias("u"), F.col("new").alias("nu"))
        at_v = moved.select(F.col("old").alias("v"), F.col("new").alias("nv"))
        edges = stored(
            edges.join(at_u, "u").join(at_v, "v").filter("nu <> nv")
            .select(F.least("nu", "nv").alias("u"), F.greatest("nu", "nv").alias("v")).distinct(),
            "links",
        )
        turn += 1
    if mapping is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return mapping
