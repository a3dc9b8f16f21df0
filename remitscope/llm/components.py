"""Connected components of a graph given as pairs of numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitscope.storage import written


def turned(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("v").alias("u"), F.col("u").alias("v"))


HOT_KEYS = 4096


def with_value(rows: DataFrame, key: str, found: DataFrame, value: str, most: int) -> DataFrame:
    """``rows`` with the ``value`` that ``found`` has for their ``key``, or null.

    ``found`` has a row per key and the number ``n`` of rows that have it. Keys of more than ``most``
    rows, which must be few, come by broadcast, so that their rows stay where they are; the rows of
    all others meet their key by a shuffle. A null key has no value.
    """
    hot = found.filter(F.col("n") > most).select(F.col(key).alias("hot_key"), F.col(value).alias("hot_value"))
    cold = found.filter(F.col("n") <= most).select(F.col(key).alias("cold_key"), F.col(value).alias("cold_value"))
    marked = rows.join(F.broadcast(hot), F.col(key) == F.col("hot_key"), "left")
    # Rows that need no partner are spread by a hash of all their columns.
    is_open = F.col("hot_key").isNull() & F.col(key).isNotNull()
    meets = F.when(is_open, F.col(key)).otherwise(F.xxhash64(*[F.col(name) for name in rows.columns]))
    joined = marked.join(cold, is_open & (meets == F.col("cold_key")), "left")
    return joined.select(*rows.columns, F.coalesce("hot_value", "cold_value").alias(value))


def least_of(edges: DataFrame) -> DataFrame:
    """The least neighbour of each node u, and how many it has."""
    return edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))


def large_star(edges: DataFrame, most: int) -> DataFrame:
    """Ties the larger neighbours of each node to the least of its neighbours and itself."""
    both = edges.unionByName(turned(edges))
    tied = with_value(both.filter("v > u"), "u", least_of(both), "m", most)
    return tied.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def small_star(edges: DataFrame, most: int) -> DataFrame:
    """Ties each node and its smaller neighbours to the least of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = least_of(down)
    tied = with_value(down, "u", least, "m", most).select(F.col("v").alias("u"), F.col("m").alias("v"))
    ends = least.select("u", F.col("m").alias("v"))
    return tied.unionByName(ends).filter("u <> v").distinct()


def mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node and root, the least node of its component, for every node of ``edges`` but the roots.

    ``edges`` has two columns u and v of type long. Stars are tied to larger and to smaller
    neighbours in turn until nothing changes, a number of rounds that grows with the logarithm of
    the nodes. Each round is written to the shared folder, so lineage stays short. A node with more
    than 1/4096 of all edges, as the centre of a star may have, gets to its edges by broadcast, so no
    such node's neighbours meet in one task. Loops and repeated edges are ignored, null nodes raise
    no error and have no component. Without edges there are no rows.
    """
    now = written(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    before = mark(now)
    while True:
        most = 1 + 2 * before[0] // HOT_KEYS
        now = written(small_star(large_star(now, most), most), "edges")
        after = mark(now)
        if after == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after
