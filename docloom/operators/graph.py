"""Orders over dependencies between rows: edges from changes, levels by peeling, cycles by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators.records import cut


def dependency_edges(changes: DataFrame, key: str, change_id: str, ts: str, before_later: Column, before_others: tuple[Column, Column]) -> DataFrame:
    """(on, id): change ``on`` comes before change ``id`` of the same record.

    ``before_later`` marks changes that all later ones of the record wait for;
    ``before_others`` is a pair of marks: changes of the first come before all
    others of the second. A record of n changes with m marked has n * m edges, which
    is what is asked for; levels of hot records without edges come from
    ``plans.metrics.dependency_order``.
    """
    c = changes.select(F.col(key).alias("k"), F.col(change_id).alias("id"), F.col(ts).alias("t"), before_later.alias("l"), before_others[0].alias("a"), before_others[1].alias("b"))
    first = c.where("l OR a").select("k", F.col("id").alias("on"), F.col("t").alias("ft"), F.col("l").alias("fl"), F.col("a").alias("fa"))
    return c.join(first, "k").where("id <> on AND ((fl AND t > ft) OR (fa AND b))").select("on", "id").distinct()


def levels(nodes: DataFrame, edges: DataFrame, node: str = "id") -> DataFrame:
    """node, level: 0 for nodes that wait for nothing, else one more than the highest they wait for; -1 in or between cycles, -2 behind one.

    ``edges`` has (on, id). Each round peels the nodes that wait for nothing any
    more; what is left is peeled from the other end, which parts the nodes behind a
    cycle from those in one. As many rounds as the longest way; a round touches
    the edges that are left only. Edges to unknown nodes are dropped, an edge of a
    node to itself is a cycle, and equal edges count once.
    """
    all_nodes = nodes.select(F.col(node).alias("id")).distinct()
    e = edges.select("on", "id").distinct().join(all_nodes.select(F.col("id").alias("on")), "on", "left_semi").join(all_nodes, "id", "left_semi")
    rest, e = cut(all_nodes), cut(e)
    done, level = [], 0
    while True:
        free = rest.join(e.select("id").distinct(), "id", "left_anti")
        free = cut(free)
        if not free.take(1):
            break
        done.append(free.select("id", F.lit(level).cast("long").alias("level")))
        rest = cut(rest.join(free, "id", "left_anti"))
        e = cut(e.join(free.select(F.col("id").alias("on")), "on", "left_anti"))
        level += 1
    # nodes that nothing left waits for are behind the cycles, not in or between them
    while e.take(1):
        last = cut(rest.join(e.select(F.col("on").alias("id")).distinct(), "id", "left_anti"))
        if not last.take(1):
            break
        done.append(last.select("id", F.lit(-2).cast("long").alias("level")))
        rest = cut(rest.join(last, "id", "left_anti"))
        e = cut(e.join(last, "id", "left_anti"))
    out = rest.select("id", F.lit(-1).cast("long").alias("level"))
    for d in done:
        out = out.unionByName(d)
    return out.withColumnRenamed("id", node)


def ordered(nodes: DataFrame, edges: DataFrame, node: str = "id") -> DataFrame:
    """node, level, position: an order that respects every edge between nodes of no cycle; nodes in or behind cycles come last.

    Positions are a level's start plus the rank in a range of the level, so no task sorts all nodes.
    """
    at = levels(nodes, edges, node).withColumn("__l", F.when(F.col("level") < 0, F.lit((1 << 62)) - F.col("level")).otherwise(F.col("level")))
    ranged = at.repartitionByRange("__l", node).sortWithinPartitions("__l", node).withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    ranged = cut(ranged)
    sizes = ranged.groupBy("__p").agg(F.count("*").alias("n"))
    starts = sizes.select("__p", F.expr("sum(n) OVER (ORDER BY __p) - n").alias("__start"))  # a row a partition
    return ranged.join(F.broadcast(starts), "__p").select(node, "level", (F.col("__start") + F.col("__i") + 1).alias("position"))
