"""Connected components of an edge table, by contraction."""

from pyspark.sql import Column, DataFrame, functions as F

from kinweave.llm.tables import written


def _mixed(value: Column) -> Column:
    """A one-to-one scrambling of 64-bit numbers, so that the order of labels has nothing to do with ids."""
    value = value.bitwiseXOR(F.shiftleft(value, 13))
    value = value.bitwiseXOR(F.shiftrightunsigned(value, 7))
    return value.bitwiseXOR(F.shiftleft(value, 17))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for every end of ``edges(a, b)``; component is the smallest node of its component.

    Each round every label points to its smallest neighbour, pointers are followed once more, and the
    edges are rewritten between what they point to. The labels that stay shrink by a constant factor
    on average, so the rounds are logarithmic. Every round is a written table; nothing is collected.
    """
    ends = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    pair = edges.where(F.col("a") != F.col("b")).select(_mixed(F.col("a")).alias("a"), _mixed(F.col("b")).alias("b"))
    both = written(pair.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
                   .select("e.a", "e.b").distinct(), f"{label}-edges")
    rounds = []
    while not both.isEmpty():
        nearest = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to"))
        further = nearest.select(F.col("a").alias("to"), F.col("to").alias("further"))
        step = written(nearest.join(further, "to").select("a", F.col("further").alias("to")), f"{label}-step")
        rounds.append(step)
        moved = both.join(step, "a").select(F.col("to").alias("x"), F.col("b").alias("a"))
        moved = moved.join(step, "a").where(F.col("x") != F.col("to")).select(F.col("x").alias("a"), F.col("to").alias("b"))
        both = written(moved.distinct(), f"{label}-edges")
    found = ends.select("node", _mixed(F.col("node")).alias("root"))
    for step in rounds:
        found = found.join(step.select(F.col("a").alias("root"), "to"), "root", "left").select(
            "node", F.coalesce("to", "root").alias("root"))
    found = written(found, f"{label}-roots")
    smallest = found.groupBy("root").agg(F.min("node").alias("component"))
    return found.join(smallest, "root").select("node", "component")
