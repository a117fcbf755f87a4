"""Phylogenetic trees as edge and closure tables."""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scale import cut_lineage


def tree_edges(spark: SparkSession, newick: str) -> DataFrame:
    """S-08: node, parent, length, tip (NULL on inner nodes) of one tree text.

    A tree is one small text; it is cut into edges here and all later work is joins.
    """
    rows, stack, last, node, label = [], [], None, 0, None
    lengths: dict[int, float] = {}
    names: dict[int, str] = {}
    parents: dict[int, int | None] = {}
    for tok in re.findall(r"'[^']*'|[(),;]|[^(),;:\s]+|:\s*[-+0-9.eE]+", newick):
        if tok == "(":
            node += 1
            parents[node] = stack[-1] if stack else None
            stack.append(node)
            last = None
        elif tok == ",":
            last = None
        elif tok == ")":
            last = stack.pop()
        elif tok == ";":
            break
        elif tok.startswith(":"):
            lengths[last] = float(tok[1:])
        elif last is None:
            node += 1
            parents[node] = stack[-1] if stack else None
            names[node] = tok.strip("'")
            last = node
    rows = [(n, p, lengths.get(n, 0.0), names.get(n)) for n, p in parents.items()]
    return spark.createDataFrame(rows, "node long, parent long, length double, tip string")


def tree_closure(edges: DataFrame, node: str = "node", parent: str = "parent",
                 length: str = "length", tip: str = "tip", max_rounds: int = 64) -> DataFrame:
    """S-08: edge, length, tip for every tip below every edge.

    Pointer doubling: each round doubles the height that has been climbed, so the number of
    joins is the logarithm of the tree height. A node that is above itself raises a ValueError.
    """
    up = edges.select(F.col(node).alias("a"), F.col(parent).alias("b")).filter("b IS NOT NULL")
    pair = lambda x, y: (x.withColumnRenamed("b", "m").join(y.withColumnRenamed("a", "m"), "m")
                         .select(F.col("a").alias("a"), F.col("b").alias("b")))
    reach = hop = cut_lineage(up)
    for _ in range(max_rounds):
        hop = cut_lineage(pair(hop, hop).distinct())
        if hop.isEmpty():
            break
        reach = cut_lineage(reach.union(hop).union(pair(reach, hop)).distinct())
        if not reach.filter("a = b").isEmpty():
            raise ValueError("the tree has a cycle")
    else:
        raise ValueError(f"the tree is higher than 2^{max_rounds} edges")
    tips = edges.filter(F.col(tip).isNotNull()).select(F.col(node).alias("a"), F.col(tip).alias("tip"))
    pairs = (tips.select("a", F.col("a").alias("b"), "tip")
             .union(tips.join(reach, "a").select("a", "b", "tip")))
    lens = edges.select(F.col(node).alias("b"), F.col(length).alias("length"))
    return pairs.join(lens, "b").select(F.col("b").alias("edge"), "length", "tip")
