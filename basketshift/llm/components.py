"""Connected components of a graph given by its links, by stars, without gathering any component."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketshift.llm.common import map_rows
from basketshift.session import stage


class UnionFind:
    """Sets under union, with the smallest member as root and paths halved on the way."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def _forest(links: DataFrame) -> DataFrame:
    """Each task's links as a forest: a link from every node that it saw to the root of its set."""

    def run(batches) -> Iterator[dict]:
        sets = UnionFind()
        for b in batches:
            for x, y in zip(b["a"], b["b"], strict=True):
                sets.join(x, y)
        pairs = [(x, sets.root(x)) for x in sets.parent]
        pairs = [p for p in pairs if p[0] != p[1]]
        yield {"a": [p[0] for p in pairs], "b": [p[1] for p in pairs]}

    return map_rows(links.select("a", "b"), run, "a bigint, b bigint")


# A node that holds more than one link in this many is a hub; so there are at most twice as many hubs.
HUB_SHARE = 1000
# Parts into which the links of a hub are dealt.
HUB_PARTS = 64


def _with_least(links: DataFrame, least: DataFrame, total: int) -> DataFrame:
    """``links`` (a, b) with the least of a. ``least`` has a, least and n, the number of links of a, which add up to ``total``.

    The links of a hub are dealt by their other end, and its least goes to each part. The list of hubs is bounded whatever the graph.
    """
    hub = F.col("n") * HUB_SHARE > total
    hubs = least.where(hub).select("a", F.lit(HUB_PARTS).alias("parts"))
    dealt = (links.join(F.broadcast(hubs), "a", "left")
             .select("a", "b", F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1))).cast("int").alias("part")))
    sent = least.select("a", "least", F.explode(F.sequence(F.lit(0), F.when(hub, HUB_PARTS - 1).otherwise(0))).alias("part"))
    return dealt.join(sent, ["a", "part"]).drop("part")


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node that it reaches) of every node with a link to another one.

    ``links`` has bigint columns a and b, in any order, repeated or not. Every task first unites what it
    holds; then larger neighbours are hung below the smallest one, and smaller ones likewise, until all links
    point to roots. The smallest neighbour of a node is a grouped minimum, added up before it moves, and travels back by a join in which the links of
    a hub are dealt over several parts. Rounds grow with the logarithm of the longest path.
    """
    links = stage(_forest(links), "links")
    while True:
        both = stage(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
        least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"), F.count(F.lit(1)).alias("n")), "least")
        large = _with_least(both, least, both.count()).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = stage(large.where("a <> b").distinct(), "links")
        least = stage(large.groupBy("a").agg(F.min("b").alias("least"), F.count(F.lit(1)).alias("n")), "least")
        joined = _with_least(large, least, large.count())
        small = joined.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b")))
        links = stage(small.distinct(), "links")
        # Done when no root is itself below another one, and every node has one root.
        if links.join(links.select(F.col("a").alias("b")).distinct(), "b", "left_semi").isEmpty() and not (
                links.groupBy("a").count().where("count > 1").limit(1).count()):
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
