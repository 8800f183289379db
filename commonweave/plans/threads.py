"""Problem 4: the comment threads of raw_reddit_item as full hierarchies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.hierarchy import descendants, hierarchy
from ..tables import latest_rows, table


def _name(column: str) -> F.Column:
    """A fullname as typed: without quotes and blanks, in lower case; null if nothing is left."""
    return F.expr(f"nullif(lower(regexp_replace({column}, '[\\\\s\"\\']', '')), '')")


def comment_links(items: DataFrame) -> DataFrame:
    """(thing_id, parent): the latest row of each comment and the fullname it hangs on.

    The parent is parent_id, if blank link_id, if blank too post_fullname. A
    bare id is the post where link_id or post_fullname names the same id, else
    a comment; a bare link_id or post_fullname is always a post.
    """
    comments = items.filter("kind = 't1' and thing_id is not null").select("thing_id", "parent_id", "link_id", "post_fullname", "fetched_at")
    comments = latest_rows(comments, ["thing_id"], [F.col("fetched_at")])
    named = comments.select(F.lower(F.trim("thing_id")).alias("thing_id"), _name("parent_id").alias("up"), _name("link_id").alias("link"), _name("post_fullname").alias("post"))

    def post(c: str) -> F.Column:
        return F.when(F.col(c).rlike("^t[0-9]_"), F.col(c)).otherwise(F.concat(F.lit("t3_"), F.col(c)))

    up = (
        F.when(F.col("up").rlike("^t[0-9]_"), F.col("up"))
        .when(F.concat(F.lit("t3_"), F.col("up")).isin(F.col("link"), F.col("post")) | (F.col("up") == F.col("link")) | (F.col("up") == F.col("post")), F.concat(F.lit("t3_"), F.col("up")))
        .otherwise(F.concat(F.lit("t1_"), F.col("up")))
    )
    return named.select("thing_id", F.coalesce(up, post("link"), post("post")).alias("parent"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Root and depth of each comment."""
    return hierarchy(comment_links(table(spark, folder, "raw_reddit_item")), "thing_id", "parent").select("thing_id", "root_id", "depth")


def p4_paths(spark: SparkSession, folder: str) -> DataFrame:
    """The path of each comment that has a root, as one string."""
    found = hierarchy(comment_links(table(spark, folder, "raw_reddit_item")), "thing_id", "parent", with_path=True)
    return found.filter("path is not null").select("thing_id", F.concat_ws("/", "path").alias("path"))


def p4_descendants(spark: SparkSession, folder: str) -> DataFrame:
    """How many things hang below each thing, and how far the farthest is."""
    pairs = descendants(comment_links(table(spark, folder, "raw_reddit_item")), "thing_id", "parent")
    return pairs.groupBy("ancestor_id").agg(F.count("*").alias("n_below"), F.max("distance").alias("farthest"))


_LINKS = r"""
rows_ AS (SELECT thing_id, parent_id, link_id, post_fullname FROM raw_reddit_item WHERE kind = 't1' AND thing_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY thing_id ORDER BY fetched_at DESC NULLS LAST) = 1),
named AS (SELECT lower(trim(thing_id)) AS id,
  nullif(lower(regexp_replace(parent_id, '[\s"'']', '', 'g')), '') AS up,
  nullif(lower(regexp_replace(link_id, '[\s"'']', '', 'g')), '') AS link,
  nullif(lower(regexp_replace(post_fullname, '[\s"'']', '', 'g')), '') AS post FROM rows_),
links AS (SELECT id, CASE
  WHEN up IS NOT NULL THEN CASE WHEN regexp_matches(up, '^t[0-9]_') THEN up
    WHEN 't3_' || up IN (coalesce(link, ''), coalesce(post, '')) OR up = link OR up = post THEN 't3_' || up ELSE 't1_' || up END
  WHEN link IS NOT NULL THEN CASE WHEN regexp_matches(link, '^t[0-9]_') THEN link ELSE 't3_' || link END
  WHEN post IS NOT NULL THEN CASE WHEN regexp_matches(post, '^t[0-9]_') THEN post ELSE 't3_' || post END END AS parent FROM named),
tree AS (SELECT l.id, l.parent AS root, 1 AS depth, l.parent || '/' || l.id AS path FROM links l
    WHERE l.parent IS NOT NULL AND l.parent NOT IN (SELECT id FROM links WHERE parent IS NOT NULL)
  UNION ALL SELECT l.id, t.root, t.depth + 1, t.path || '/' || l.id FROM links l JOIN tree t ON l.parent = t.id)
"""

QUERIES = {"p4_found": p4_found, "p4_paths": p4_paths, "p4_descendants": p4_descendants}
SQL = {
    "p4_found": f"WITH RECURSIVE {_LINKS} SELECT l.id AS thing_id, coalesce(t.root, CASE WHEN l.parent IS NULL THEN l.id ELSE 'cycle' END) AS root_id, "
    "CAST(coalesce(t.depth, CASE WHEN l.parent IS NULL THEN 0 ELSE -1 END) AS INTEGER) AS depth FROM links l LEFT JOIN tree t ON t.id = l.id",
    "p4_paths": f"WITH RECURSIVE {_LINKS} SELECT id AS thing_id, path FROM tree",
    "p4_descendants": f"WITH RECURSIVE {_LINKS}, pairs AS (SELECT unnest(string_split(path, '/')) AS a, generate_subscripts(string_split(path, '/'), 1) AS pos, depth FROM tree) "
    "SELECT a AS ancestor_id, CAST(count(*) AS BIGINT) AS n_below, CAST(max(depth - pos + 1) AS INTEGER) AS farthest FROM pairs WHERE pos <= depth GROUP BY a",
}
