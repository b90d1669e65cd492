"""Connected components by repeated random contraction of the graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdure.operators.skew import salted_lookup
from verdure.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected ``edges`` (a, b).

    Each round every node picks the neighbour (or itself) with the least hash for
    that pair of rounds, joins what that one picked, and edges are rewritten to the chosen nodes. A constant share of
    the nodes disappears per pair whatever the shape, so long chains take
    logarithmically many rounds and all rounds together cost about as much as the
    first few. The hashes change with every second round only: the first makes the least node of a star its centre,
    which the second then finds again, so a star of any size is gone after two. The per-node minimum is combined before the shuffle and the rewrite
    is salted, so a node with very many neighbours is no bottleneck. The component
    id is one of its nodes.
    """
    live = materialize(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a <> b")
        .distinct(),
        "edges",
    )
    steps: list[DataFrame] = []
    while not live.isEmpty():
        chosen = materialize(_choose(live, len(steps) // 2), "chosen")
        steps.append(chosen)
        first = chosen.select(F.col("node").alias("a"), F.col("target").alias("ta"))
        second = chosen.select(F.col("node").alias("b"), F.col("target").alias("tb"))
        moved = salted_lookup(salted_lookup(live, first, ["a"]), second, ["b"])
        live = materialize(
            moved.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
            .where("a <> b")
            .distinct(),
            "edges",
        )
    if not steps:
        return live.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = steps[-1].select("node", F.col("target").alias("component"))
    for i, step in enumerate(reversed(steps[:-1])):
        # a target that did not appear in the next round is already final
        later = labels.withColumnRenamed("node", "target")
        labels = salted_lookup(step, later, ["target"], "left").select(
            "node", F.coalesce("component", "target").alias("component")
        )
        if i % 4 == 3:
            labels = materialize(labels, "labels")
    return materialize(labels, "labels")


def _choose(live: DataFrame, pair_no: int) -> DataFrame:
    def priority(node: str):
        return F.struct(F.xxhash64(F.lit(pair_no), F.col(node)).alias("h"), F.col(node).alias("n"))

    both = live.select(F.col("a").alias("node"), priority("b").alias("p")).unionByName(
        live.select(F.col("b").alias("node"), priority("a").alias("p"))
    )
    best = both.groupBy("node").agg(F.min("p").alias("p"))
    one = best.select("node", F.least("p", priority("node"))["n"].alias("target"))
    # follow the choice of the chosen node too: fewer rounds for one more lookup
    onward = one.select(F.col("node").alias("target"), F.col("target").alias("next"))
    return salted_lookup(one, onward, ["target"]).select("node", F.col("next").alias("target"))
