"""Connected components of a link table, by repeated contraction of stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.llm.common import stash


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``, long); root is the smallest node reachable.

    Each round lets every node follow its smallest neighbour (or itself), follows
    on to the end by doubling, and replaces both ends of each link by what they
    follow. At least half of the nodes are gone after a round, so there are few
    rounds. Nodes only ever follow smaller ones, and the last table of followed
    nodes that knows a node gives its root. Links stay distributed; the driver
    only sees whether any are left.

    Cases: loops and repeated links are allowed; null ends are ignored; an empty
    table gives no rows.
    """
    links = links.select("a", "b").where("a is not null and b is not null")
    links = stash(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    rounds = []
    while not links.where("a <> b").isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        follow = stash(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("to")), "follow")
        while True:
            on = follow.select(F.col("node").alias("to"), F.col("to").alias("further"))
            moved = follow.join(on, "to").where("further <> to")
            if moved.isEmpty():
                break
            follow = stash(follow.join(on, "to").select("node", F.col("further").alias("to")), "follow")
        rounds.append(follow)
        moved = links.join(follow.select(F.col("node").alias("a"), F.col("to").alias("to_a")), "a")
        moved = moved.join(follow.select(F.col("node").alias("b"), F.col("to").alias("to_b")), "b")
        links = moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        links = stash(links.where("a <> b").distinct(), "links")
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    roots = None
    for follow in reversed(rounds):
        if roots is None:
            roots = follow.select("node", F.col("to").alias("root"))
        else:
            later = roots.select(F.col("node").alias("to"), "root")
            roots = follow.join(later, "to", "left").select("node", F.coalesce("root", "to").alias("root"))
        roots = stash(roots, "roots")
    return roots
