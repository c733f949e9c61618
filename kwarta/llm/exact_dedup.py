"""Exact deduplication with a heavy-hitter split: only DataFrame functions.

A Misra-Gries pass finds digests that may be frequent, an exact count verifies them, and the winners, at most
1 / support rows, are broadcast: copies of a frequent text are settled where they are read. Every other
digest has fewer than support x rows copies, so one ordinary shuffle of digests stays even.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kwarta.llm.shared import carried, restored

#: A digest held by at least this share of the rows is frequent; the broadcast holds at most 1 / SUPPORT rows.
SUPPORT = 0.001


def as_is(text: Column) -> Column:
    """Texts are equal when identical."""
    return text


def frequent(digests: DataFrame, support: float) -> DataFrame:
    """Digests held by at least that share of the rows, with their exact count and largest id.

    Misra-Gries with 1 / support counters per task misses none of them; those it names by mistake fail the
    exact count.
    """
    rows = digests.count()
    named = digests.stat.freqItems(["_digest"], support).select(F.explode("_digest_freqItems").alias("_digest"))
    return (
        digests.join(F.broadcast(named), "_digest")
        .groupBy("_digest").agg(F.max("_id").alias("_top"), F.count(F.lit(1)).alias("_copies"))
        .where(F.col("_copies") >= max(2, support * rows))
    )


def mark_copies(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, columns: Iterable[str] | None = None,
    normalise: Callable[[Column], Column] = as_is, support: float = SUPPORT, dropped: bool = True,
) -> DataFrame:
    """The given columns (default: doc_id) with keep_id, group_size, kept and text_sha256, one row per row.

    Of rows with equal normalised text the one with the largest doc_id stays. A null text counts as empty. A
    null doc_id is below all others. Of repeated rows (same text and doc_id) one stays. If no row of a group
    has a doc_id, keep_id is null and one row stays. Empty table: no rows. Input columns that have the name of
    a result are not carried. With dropped=False only rows that stay come back, and copies of frequent texts
    are never shuffled.
    """
    own = {"keep_id", "group_size", "kept", "text_sha256"}
    names = [n for n in (columns if columns is not None else [doc_id]) if n not in own]
    digest = F.sha2(F.coalesce(normalise(docs[f"`{text}`"].cast("string")), F.lit("")).cast("binary"), 256)
    rows = docs.select(docs[f"`{doc_id}`"].alias("_id"), digest.alias("_digest"), *carried(docs, names))
    winners = frequent(rows.select("_id", "_digest"), support)
    known = rows.join(F.broadcast(winners), "_digest", "left")
    loses = F.col("_copies").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_top"))
    group = Window.partitionBy("_digest")
    first = F.row_number().over(group.orderBy(F.col("_id").desc_nulls_last()))
    rest = known.where(~loses).select(
        *restored(names),
        F.max("_id").over(group).alias("keep_id"),
        F.coalesce("_copies", F.count(F.lit(1)).over(group)).alias("group_size"),
        (first == 1).alias("kept"),
        F.col("_digest").alias("text_sha256"),
    )
    if not dropped:
        return rest.where("kept")
    copies = known.where(loses).select(
        *restored(names), F.col("_top").alias("keep_id"), F.col("_copies").alias("group_size"),
        F.lit(False).alias("kept"), F.col("_digest").alias("text_sha256"),
    )
    return copies.unionByName(rest)
