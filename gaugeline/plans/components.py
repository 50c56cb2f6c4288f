"""Connected components by hooking to the smallest neighbour and contracting."""

from pyspark.sql import DataFrame, functions as F

from gaugeline.plans.joins import HOT_ROWS, hot_safe_join
from gaugeline.plans.scratch import materialize


def connected_components(nodes: DataFrame, edges: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(node, root) for `nodes` (node) and undirected `edges` (a, b); the root is the smallest node of the component.

    Each round hooks every node to its smallest neighbour, follows the hooks four steps, and contracts the edges along
    them. A contracted edge still ties a node to what lies further down its chain of hooks, so following them to the
    end in one round is not needed. Every round is a written table, and joins on a node that many rows share broadcast
    that node.
    """
    edges = edges.select("a", "b")
    small = nodes.count() <= hot_rows and edges.count() <= hot_rows

    def follow(rows: DataFrame, column: str, up: DataFrame) -> DataFrame:
        table = up.select(F.col("node").alias(column), F.col("up").alias("_up"))
        if small:
            moved = rows.join(table, column, "left")
        else:
            moved = hot_safe_join(rows, table, [column], "left", hot_rows)
        return moved.withColumn(column, F.coalesce("_up", column)).select(*rows.columns)

    def both_ways(pairs: DataFrame) -> DataFrame:
        pairs = pairs.filter("a <> b")
        return materialize(pairs.union(pairs.select("b", "a")).distinct(), "edges")

    labels = nodes.select("node", F.col("node").alias("root"))
    edges = both_ways(edges)
    while not edges.isEmpty():
        smallest = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_b"))
        up = materialize(smallest.select("node", F.least("_b", "node").alias("up")), "hooks")
        two = follow(up, "up", up)
        if not small:  # a split join reads its input several times, so nested ones would multiply
            two = materialize(two, "hooks")
        up = materialize(follow(two, "up", two), "hooks")
        labels = follow(labels, "root", up)
        moved = follow(edges, "a", up)
        if not small:
            labels, moved = materialize(labels, "labels"), materialize(moved, "edges")
        edges = both_ways(follow(moved, "b", up))
    return materialize(labels, "labels")
