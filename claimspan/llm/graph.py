"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspan.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is named after its smallest node.

    In each round a node joins its smallest neighbour (if smaller than itself)
    and then that one's choice; edges are carried over to the chosen nodes and
    loops drop out. The smallest node of a component never joins another one.
    The number of edges falls by rounds, which are about as many as the
    logarithm of the longest path. Nothing is gathered by node: choices are
    minima, combined before they are shuffled.
    """
    rest = scratch.table(edges.where("a <> b").selectExpr("least(a, b) a", "greatest(a, b) b").distinct(), "edges")
    found = None
    while not rest.isEmpty():
        both = rest.union(rest.select("b", "a"))
        near = both.groupBy("a").agg(F.min("b").alias("b")).selectExpr("a node", "least(a, b) up")
        near = scratch.table(near, "choices")
        next_ = near.selectExpr("node as up", "up as top")
        jumped = scratch.table(near.join(next_, "up").selectExpr("node", "top"), "jumps")
        if found is None:
            found = jumped.withColumnRenamed("top", "component")
        else:
            step = jumped.selectExpr("node as component", "top")
            found = found.join(step, "component", "left").selectExpr("node", "coalesce(top, component) component")
        found = scratch.table(found, "components")
        rest = scratch.table(
            rest.join(jumped.selectExpr("node a", "top left_top"), "a")
            .join(jumped.selectExpr("node b", "top right_top"), "b")
            .where("left_top <> right_top")
            .selectExpr("least(left_top, right_top) a", "greatest(left_top, right_top) b")
            .distinct(),
            "edges",
        )
    return found if found is not None else rest.selectExpr("a node", "b component")
