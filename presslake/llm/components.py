"""Connected components of a distributed link list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``: the smallest node it
    is connected with (itself included).

    Each round points every node at its smallest neighbour, follows the pointers
    twice, renames the links' ends and drops links within one name. A smallest
    node keeps its own name, so the last name left is the smallest. The rounds
    grow with the logarithm of the longest chain; each is written to the shared
    folder. NULL ends and links of a node with itself say nothing and are left out.
    All joins are sort-merge joins: names that are alike make small files, and by
    these Spark would broadcast millions of rows.
    """
    links = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    links = written(links.distinct(), "links")
    names = written(links.select("a").union(links.select("b")).distinct()
                    .select(F.col("a").alias("node"), F.col("a").alias("root")), "names")
    while not links.isEmpty():
        ends = links.union(links.select("b", "a"))
        p = ends.groupBy("a").agg(F.least("a", F.min("b")).alias("p"))
        p = written(p, "pointers")
        for _ in range(2):
            q = p.select(F.col("a").alias("p"), F.col("p").alias("next")).hint("merge")
            p = written(p.join(q, "p").select("a", F.col("next").alias("p")), "pointers")
        to = p.select(F.col("a").alias("x"), F.col("p").alias("to")).hint("merge")
        renamed = (links.join(to, links["a"] == to["x"]).select(F.col("to").alias("a"), "b")
                   .join(to, F.col("b") == to["x"]).select("a", F.col("to").alias("b")))
        # a pointer's target may itself point on: that link stays
        further = p.join(to, p["p"] == to["x"]).select(F.col("p").alias("a"), F.col("to").alias("b"))
        names = written(names.join(to, names["root"] == to["x"], "left")
                        .select("node", F.coalesce("to", "root").alias("root")), "names")
        links = written(renamed.union(further).where("a <> b")
                        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    return names
