"""Boilerplate lines, by the share of a host's pages that hold them.

Pages are counted by their distinct texts: a page that a host serves many times counts once,
so that copies of an article don't make its own lines look like boilerplate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimhistory import Staging
from dimhistory.llm.frames import unused

#: The most boilerplate lines that are broadcast; more are joined by host through a shuffle.
BROADCAST_LINES = 200_000
#: Parts of a host's boilerplate, of which a line is looked up in one.
SLOTS = 64
BLANKS = " \t\r\x0b\x0c"


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def _digest(text: Column) -> Column:
    """Two 64-bit hashes, which together stand for a text."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def _slot(key: Column) -> Column:
    """The place of a line among those of its host: only the lines of one slot are compared."""
    return F.pmod(key["a"], F.lit(SLOTS)).cast("int")


def boilerplate(
    docs: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    ratio: float = 0.1,
    least_pages: int = 2,
    full_length: int | None = 32,
) -> DataFrame:
    """``(host, key, pages, total)``: lines on more than ``ratio`` of a host's pages.

    Lines on fewer than ``least_pages`` distinct pages never count, blank lines neither. Rows
    without host form one host of their own; null and empty texts are no pages.

    With ``full_length`` the share falls with a line's length, because a long passage hardly
    comes back by chance: lines of up to so many characters, trimmed, need more than ``ratio``
    of the pages, longer ones more than ``ratio * full_length / characters``. With None every
    line needs the same share.
    """

    pages = (
        docs.select(F.col(host_col).alias("host"), F.col(text_col).alias("text"))
        .where(F.length("text") > 0)
        .select("host", _digest(F.col("text")).alias("page"), "text")
    )
    lines = pages.select("host", "page", F.explode(F.split("text", "\n")).alias("line"))
    lines = lines.withColumn("line", _trimmed(F.col("line"))).where("line <> ''")
    length = F.lit(1) if full_length is None else F.length("line")
    # copies fall together, before and after the shuffle, ahead of the counting
    counted = (
        lines.select("host", "page", _digest(F.col("line")).alias("key"), length.alias("length"))
        .select("host", "page.a", "page.b", "key", "length")
        .distinct()
        .groupBy("host", "key", "length")
        .agg(F.count("*").alias("pages"))
        .where(F.col("pages") >= least_pages)
    )
    totals = pages.select("host", "page").distinct().groupBy("host")
    totals = totals.agg(F.count("*").alias("total"))
    same = counted["host"].eqNullSafe(totals["host"])
    least = F.lit(ratio)
    if full_length is not None:
        least = least * F.least(F.lit(1.0), F.lit(full_length) / F.col("length"))
    return (
        counted.join(totals, same)
        .where(F.col("pages") > least * F.col("total"))
        .select(counted["host"], "key", "pages", "total")
    )


def drop_boilerplate(
    docs: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    ratio: float = 0.1,
    least_pages: int = 2,
    full_length: int | None = 32,
) -> DataFrame:
    """``docs`` with the boilerplate lines of its host taken from each text.

    Adds ``n_lines`` (lines that are not blank) and ``n_dropped``. A null text stays null and an
    empty one empty, with zero lines; a text that is boilerplate throughout becomes empty;
    repeated rows stay; an empty table gives no rows. All other columns pass through; input
    columns named like the two added ones are replaced.

    ``ratio``, ``least_pages`` and ``full_length`` are those of :func:`boilerplate`. The
    boilerplate of a host holds at most (mean lines a page / ratio) lines, and with
    ``full_length`` at most (mean characters a page / (ratio * full_length)) longer ones,
    whatever the number of its pages. The lines are written once and counted: up to ``BROADCAST_LINES`` are
    broadcast, more are joined by host, where adaptive execution splits a hot host.
    """
    spark = docs.sparkSession
    found = boilerplate(docs, host_col, text_col, ratio, least_pages, full_length)
    host, keys, kept = (unused(docs, name) for name in ("__host", "__keys", "__kept"))
    by_host = found.groupBy("host").agg(F.collect_list("key").alias("keys"))
    slots = F.sequence(F.lit(0), F.lit(SLOTS - 1))
    in_slots = F.transform(slots, lambda i: F.filter("keys", lambda key: _slot(key) == i))
    by_host = Staging(spark).write(by_host.select(F.col("host").alias(host), in_slots.alias(keys)), "boilerplate")
    lines = by_host.agg(F.sum(F.size(F.flatten(keys)))).first()[0] or 0
    if lines <= BROADCAST_LINES:
        by_host = F.broadcast(by_host)
    joined = docs.drop("n_lines", "n_dropped").join(
        by_host, F.col(host_col).eqNullSafe(F.col(host)), "left"
    )
    split = F.split(F.col(text_col), "\n")
    worded = F.size(F.filter(split, lambda line: _trimmed(line) != ""))

    def listed(line: Column) -> Column:
        key = _digest(_trimmed(line))
        return F.array_contains(F.get(F.col(keys), _slot(key)), key)

    left = F.when(F.col(keys).isNull(), split).otherwise(F.filter(split, lambda line: ~listed(line)))
    return (
        joined.withColumn(kept, left)
        .withColumn("n_lines", F.coalesce(F.when(F.col(text_col) == "", 0).otherwise(worded), F.lit(0)).cast("long"))
        .withColumn("n_dropped", F.coalesce(F.size(split) - F.size(kept), F.lit(0)).cast("long"))
        .withColumn(text_col, F.array_join(kept, "\n"))
        .drop(kept, keys, host)
    )
