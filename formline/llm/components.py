"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formline.llm.scratch import Scratch
from formline.session import reliable_checkpoint


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component`` for every id in the links; a component is named by its smallest id.

    Each round every node moves to its first neighbour, or stays if it comes first
    itself, and links between the places left form the next round's graph. Rounds
    go by id, which ends stars around a smallest id at once, and by a random order
    in turn, which shortens long chains by a constant factor. Labels and links
    stay distributed: they are written each round, joins are never broadcasts, and
    the driver only asks whether links are left. Links with a null end are ignored.
    """
    scratch = Scratch(links.sparkSession, "components")
    links = scratch.table(links.select(F.col(a).alias("a"), F.col(b).alias("b")).distinct())
    edges = links.filter("a is not null and b is not null and a <> b")
    labels = links.select(F.explode(F.array("a", "b")).alias("id")).filter("id is not null").distinct().withColumn("label", F.col("id"))
    turn = 0
    while not edges.isEmpty():
        turn += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moves = scratch.table(
            both.groupBy(F.col("a").alias("at")).agg(F.min(_place("b", turn)).alias("to"))
            .select("at", F.least("to", _place("at", turn))["id"].alias("to"))
        )
        labels = labels.join(moves.hint("merge"), F.col("label") == F.col("at"), "left").select("id", F.coalesce("to", "label").alias("label"))
        first, second = moves.toDF("a", "x"), moves.toDF("b", "y")
        edges = scratch.table(
            edges.join(first.hint("merge"), "a").join(second.hint("merge"), "b").filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )
    labels = scratch.table(labels)
    smallest = labels.groupBy("label").agg(F.min("id").alias("component"))
    found = reliable_checkpoint(labels.join(smallest.hint("merge"), "label").select("id", "component"))
    scratch.drop()
    return found


def _place(node: str, turn: int) -> Column:
    """The node's place in the order of the round."""
    order = F.lit(0).cast("long") if turn % 2 else F.xxhash64(F.lit(turn), node)
    return F.struct(order.alias("order"), F.col(node).alias("id"))
