"""Graph operators on edge lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def weighted_in_degree(edges: DataFrame) -> DataFrame:
    """(dst, strength): the sum of the strengths of the edges into each node."""
    return edges.groupBy("dst").agg(F.sum("strength").alias("strength"))


def neighbours(edges: DataFrame, node: str = "src", other: str = "dst") -> DataFrame:
    """(node, neighbours): the nodes one edge away, sorted."""
    return edges.groupBy(node).agg(F.array_sort(F.collect_set(other)).alias("neighbours"))


#: Rows of a frontier that are sent to every worker instead of shuffling all edges.
FRONTIER_ROWS = 100_000


def within_hops(edges: DataFrame, starts: DataFrame, hops: int, frontier_rows: int = FRONTIER_ROWS) -> DataFrame:
    """(start, node, depth): the nodes that each start reaches within `hops` edges,
    with the least number of edges. Each round joins the frontier with the edges and
    drops what was reached before, so a node is widened once for each start. The
    edges are reduced by the frontier before anything is made distinct; a frontier
    of few rows, which is counted, is broadcast, a larger one joined by shuffle."""
    ways = edges.select("src", "dst")
    reached = frontier = cut(starts.select(F.col("id").alias("start"), F.col("id").alias("node"), F.lit(0).alias("depth")).distinct())
    for depth in range(1, hops + 1):
        at = frontier.select("start", F.col("node").alias("src"))
        few = frontier.limit(frontier_rows + 1).count() <= frontier_rows
        step = ways.join(F.broadcast(at) if few else at, "src").select("start", F.col("dst").alias("node")).distinct()
        frontier = cut(step.join(reached.select("start", "node"), ["start", "node"], "left_anti").withColumn("depth", F.lit(depth)))
        reached = reached.unionByName(frontier)
    return reached.filter("depth > 0")


def membership_edges(attendance: DataFrame) -> DataFrame:
    """(person_id, event_id, edge_type): who organized and who attended what; an organizer's attendance is not told again."""
    led = F.col("role").isin("organizer", "co_organizer")
    marked = attendance.select("person_id", "event_id", led.cast("int").alias("led")).dropna()
    return marked.groupBy("person_id", "event_id").agg(F.max("led").alias("led")).select("person_id", "event_id", F.when(F.col("led") == 1, "organized").otherwise("attended").alias("edge_type"))


def reply_edges(items: DataFrame, item: str, parent: str, author: str) -> DataFrame:
    """(src, dst, edge_type, record_id, seen_at): who answered whom, by the parent's author; no self edges."""
    child = items.select(F.col(author).alias("src"), F.col(parent).alias("_up"), F.col(item).alias("record_id"), "seen_at").filter("src is not null and _up is not null")
    above = items.select(F.col(item).alias("_up"), F.col(author).alias("dst")).filter("dst is not null")
    return child.join(above, "_up").filter("src <> dst").select("src", "dst", F.lit("replies_to").alias("edge_type"), "record_id", "seen_at")


def mention_edges(texts: DataFrame, known: DataFrame) -> DataFrame:
    """Edges from texts(author, record_id, seen_at, handles) to known(handle, person): each mention of a known handle."""
    named = texts.select(F.col("author").alias("src"), "record_id", "seen_at", F.explode("handles").alias("handle"))
    return named.join(known.select("handle", F.col("person").alias("dst")), "handle").filter("src <> dst").select("src", "dst", F.lit("mentions").alias("edge_type"), "record_id", "seen_at").distinct()
