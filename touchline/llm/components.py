"""Connected components of a table of links, by hooking and pointer jumping; nothing of it reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import stage


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every end of ``links`` (a long, b long); the root is one node of the component.

    Each round lets every group hook to its smallest neighbour if that is smaller, shortens the chains that arise until
    each hooked group points to a group that stays, and puts the groups' names into the links. Links within a group
    are dropped, so rounds get smaller; a star takes two, a chain about as many as its length has digits in base 2.
    Smallest neighbours are combined before the shuffle, and what a join adds is a staged table.
    """
    links = links.filter("a IS NOT NULL AND b IS NOT NULL")
    nodes = stage(links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node")))
    edges = stage(links.select("a", "b").filter("a <> b").distinct())
    while not edges.isEmpty():
        both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
        hooks = jumped(stage(both.groupBy("a").agg(F.min("b").alias("to")).filter("to < a")))
        nodes = stage(renamed(nodes, hooks, "root"))
        edges = stage(renamed(renamed(edges, hooks, "a"), hooks, "b").filter("a <> b").distinct())
    return nodes


def jumped(hooks: DataFrame) -> DataFrame:
    """``hooks`` (a, to) with every chain followed to its end."""
    while True:
        longer = hooks.select(F.col("a").alias("to"), F.col("to").alias("further"))
        joined = stage(hooks.join(longer, "to", "left").select("a", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")))
        hooks = joined.select("a", "to")
        if joined.filter("moved").isEmpty():
            return hooks


def renamed(table: DataFrame, hooks: DataFrame, column: str) -> DataFrame:
    to = hooks.select(F.col("a").alias(column), F.col("to").alias("new name"))
    return table.join(to, column, "left").withColumn(column, F.coalesce("new name", column)).drop("new name")
