"""Connected components of a table of links, by alternating large-star and small-star steps.

Each step links every node of a neighbourhood to the smallest one, so a component becomes a star around its smallest node
in a number of rounds that grows with the logarithm of its diameter. A round is two minima and two joins; its links are
written to the shared folder, so lineage ends and a lost executor loses nothing. Only a count and a checksum per round
reach the driver. The minima are written before they are joined, so both sides of a join are shuffled and Spark can split a
node that holds most links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.session import Stages


def connected(links: DataFrame, stages: Stages, name: str = "links") -> DataFrame:
    """(id, root) for every node of links (a, b), any orderable type; root is the component's smallest node. Nulls and links of
    a node to itself are ignored; a node without another is not returned."""
    a, b = F.col("a"), F.col("b")
    links = links.filter(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    links = stages.write(links, f"{name}-0")
    before, turn = None, 0
    while True:
        turn += 1
        both = links.union(links.select("b", "a"))
        least = stages.write(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), f"{name}-low-{turn}")
        # large star: neighbours above a node go to the smallest of its neighbourhood
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stages.write(large, f"{name}-large-{turn}")
        least = stages.write(large.groupBy("a").agg(F.min("b").alias("m")), f"{name}-least-{turn}")
        # small star: a node and its neighbours below go to the smallest of these
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").union(least.select("a", F.col("m").alias("b")))
        after = stages.write(small.distinct(), f"{name}-{turn}")
        state = after.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first()
        stages.remove(f"{name}-low-{turn}", f"{name}-large-{turn}", f"{name}-least-{turn}", f"{name}-{turn - 1}")
        links = after
        if state == before or state[0] == 0:
            return links.select(F.col("a").alias("id"), F.col("b").alias("root")).union(links.select("b", "b").distinct())
        before = state
