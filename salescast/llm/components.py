"""Connected components of a distributed graph by repeated contraction."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.session import discard, materialize


def components(edges: DataFrame) -> DataFrame:
    """For each node of ``edges`` (a, b: long, not null) a representative of its component, as (node, root).

    In every round each node moves to the least of its neighbours and itself, in an order that changes with the round, and
    the edges move with their ends; edges within a node vanish. The number of rounds grows with the logarithm of the
    graph, and each is a combinable aggregate and two joins whose hot keys adaptive execution can split. A round's
    tables go when the next are written. Nothing is gathered on the driver but whether edges are left. An empty graph has no rows.
    """
    edges = materialize(edges.select("a", "b").where("a <> b").distinct(), "edges")
    roots = materialize(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                        .withColumn("root", F.col("node")), "roots")
    order = random.Random(7)
    while not edges.isEmpty():
        turn = F.lit(order.getrandbits(62))
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        move = both.groupBy("a").agg(F.min(F.col("b").bitwiseXOR(turn)).alias("least")).select(
            "a", F.least("least", F.col("a").bitwiseXOR(turn)).bitwiseXOR(turn).alias("to"))
        move = materialize(move.where("a <> to"), "moves")
        one, two = (move.select(F.col("a").alias(c), F.col("to").alias(f"{c}_to")) for c in ("a", "b"))
        past = edges, roots, move
        edges = materialize(
            edges.join(one, "a", "left").join(two, "b", "left")
            .select(F.coalesce("a_to", "a").alias("x"), F.coalesce("b_to", "b").alias("y")).where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        roots = materialize(
            roots.join(move.select(F.col("a").alias("root"), "to"), "root", "left")
            .select("node", F.coalesce("to", "root").alias("root")), "roots")
        discard(*past)
    discard(edges)
    return roots
