"""Connected components of links between rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimhistory import Staging

#: Links that a task writes in a round, so that few links are few files.
LINKS = 100_000


def grown(found: DataFrame, more: DataFrame, staging: Staging) -> DataFrame:
    """``components`` of the links behind ``found``, its result for them, and of ``more``.

    Every node hangs on its component already, so only what ``more`` joins moves again. ``more`` is
    read more than once, so it should be staged.
    """
    more = more.select("a", "b")
    if more.isEmpty():
        return found
    return components(more.union(found.select("node", "component").toDF("a", "b")), staging)


def components(links: DataFrame, staging: Staging) -> DataFrame:
    """``(node, component)``, the smallest node reachable, for every node with a link.

    ``links`` has long columns ``a`` and ``b``. Each round hangs the neighbours of a node on the
    smallest of them, larger and smaller neighbours in turn, until nothing moves; the number of
    links never grows. Every round is written to the shared folder, which cuts lineage, by as many
    tasks as its links need. ``links`` is read twice: once to count them.
    """
    most = links.count()
    pairs = links.where("a <> b").select(
        F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")
    )
    moved = {"n": "count(*)", "sum": "sum(xxhash64(node, root) % 1000003)"}
    pairs, after = staging.observed(_in_few(pairs.distinct(), most), "links", moved)
    before = None
    while after["n"] and after != before:
        both = pairs.union(pairs.select("root", "node")).toDF("node", "other")
        least = both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("least"))
        # a row for each link at most; its copies go with those of the round
        large = both.where("other > node").join(least, "node")
        large = large.where("other <> least").select("other", "least").toDF("node", "root")
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(least, "node").where("root <> least").select("root", "least")
        small = small.union(least.select("node", "least")).distinct().toDF("node", "root")
        before = after
        pairs, after = staging.observed(_in_few(small, after["n"]), "links", moved)
    roots = pairs.select(F.col("root").alias("node"), F.col("root").alias("component")).distinct()
    return pairs.select("node", F.col("root").alias("component")).union(roots)


def _in_few(links: DataFrame, most: int) -> DataFrame:
    """``links`` in as many partitions as ``most`` rows need, or fewer."""
    return links.coalesce(max(1, -(-most // LINKS)))
