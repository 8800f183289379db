"""Parent-child rows to full hierarchies: root, depth, path, descendants, cycles.

The frontier of nodes that still wait for their root is joined level by level,
with levels that double: every node carries a jump to an ancestor, and joining
jumps with jumps doubles their length, so that round k reaches the nodes of
depth 2^(k-1)+1 to 2^k at once and a chain of depth d costs log2(d) joins. (This is
pointer doubling from every node upwards, where a frontier walked down from the
roots would take d joins.) A round that reaches nobody proves that the nodes left
lie in a cycle or below one: a node at the next depth would have been reached.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

#: The root given to nodes in a cycle or below one, and their depth.
CYCLE, CYCLE_DEPTH = "cycle", -1


def hierarchy(nodes: DataFrame, id_col: str, parent_col: str, with_path: bool = False) -> DataFrame:
    """(id_col, root_id, depth[, path]) for each node.

    root_id is the last id reached, whether or not it is a row of its own, and
    depth the number of steps to it; path lists the ids from the root to the
    node. A node without parent is its own root at depth 0. Nodes in a cycle or
    below one get root_id 'cycle', depth -1 and a null path. Rows without id
    are left out, repeated rows count once, and of different parents of one id
    the least holds. An empty table gives an empty result.
    """
    pairs = nodes.select(F.col(id_col).cast("string").alias("id"), F.col(parent_col).cast("string").alias("ptr"))
    pairs = pairs.filter("id is not null").groupBy("id").agg(F.min("ptr").alias("ptr"))
    seg = [F.array("id").alias("seg")] if with_path else []
    own = [F.array("id").alias("path")] if with_path else []
    pairs = cut(pairs)
    inner = pairs.filter("ptr is not null")
    tops = pairs.filter("ptr is null").select("id", F.col("id").alias("root_id"), F.lit(0).alias("depth"), *own)
    known = inner.select(F.col("id").alias("p_id"), F.lit(True).alias("is_inner"))
    state = inner.join(known, F.col("ptr") == F.col("p_id"), "left").select(
        "id", "ptr", F.lit(1).cast("long").alias("dist"), F.col("is_inner").isNull().alias("done"), *seg
    )
    state = cut(state)
    reached, waiting = state.filter("done"), state.filter("not done")
    while True:
        jumps = reached.unionByName(waiting)
        jumps = jumps.select(*[F.col(c).alias(f"p_{c}") for c in jumps.columns])
        longer = [F.concat("seg", "p_seg").alias("seg")] if with_path else []
        step = waiting.join(jumps, F.col("ptr") == F.col("p_id")).select(
            "id", F.col("p_ptr").alias("ptr"), (F.col("dist") + F.col("p_dist")).alias("dist"), F.col("p_done").alias("done"), *longer
        )
        step = cut(step)
        count = step.agg(F.count("*").alias("all"), F.count(F.when(F.col("done"), 1)).alias("new")).first()
        reached, waiting = reached.unionByName(step.filter("done")), step.filter("not done")
        if count["new"] == 0 or count["new"] == count["all"]:
            break
    full = [F.concat(F.array("ptr"), F.reverse("seg")).alias("path")] if with_path else []
    none = [F.lit(None).cast("array<string>").alias("path")] if with_path else []
    below = reached.select("id", F.col("ptr").alias("root_id"), F.col("dist").cast("int").alias("depth"), *full)
    looped = waiting.select("id", F.lit(CYCLE).alias("root_id"), F.lit(CYCLE_DEPTH).alias("depth"), *none)
    return tops.unionByName(below).unionByName(looped).withColumnRenamed("id", id_col)


def descendants(nodes: DataFrame, id_col: str, parent_col: str) -> DataFrame:
    """(ancestor_id, descendant_id, distance): one row for each node below each
    ancestor, ancestors without a row of their own included. Nodes in a cycle
    or below one have no finite list and give no row; hierarchy() tells them."""
    paths = hierarchy(nodes, id_col, parent_col, with_path=True).filter("path is not null")
    pairs = paths.select(F.col(id_col).alias("descendant_id"), F.posexplode("path").alias("pos", "ancestor_id"), F.col("depth"))
    return pairs.filter("pos < depth").select("ancestor_id", "descendant_id", (F.col("depth") - F.col("pos")).alias("distance"))
