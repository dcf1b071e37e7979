"""Shared timelines: order, batches of targets with context, payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Start of rows without one: behind all others.
NO_START = 1e12


def positions(rows: DataFrame, source: str, order: list[str]) -> DataFrame:
    """rows with their position (from 0) and number of rows in the source."""
    window = Window.partitionBy(source)
    return rows.withColumn("pos", F.row_number().over(window.orderBy(*order)) - 1).withColumn("rows_in_source", F.count("*").over(window))


def ordinal(target: int):
    """Batch of a position."""
    return F.floor(F.col("pos") / F.lit(target)).cast("int")


def windows(rows: DataFrame, source: str, target: int = 16, context: int = 10) -> DataFrame:
    """A row for each batch that shows an item: rows, ordinal, role (target or context_only).

    Item p belongs to batch p div target, and is context of each batch whose span widened by `context` on both
    sides holds it. Candidate batches are few and follow from p, so this is an explode, not a range join.
    """
    size, reach = F.lit(target), F.lit(context)
    last = F.floor((F.col("rows_in_source") - 1) / size).cast("int")
    lo = F.greatest(F.floor((F.col("pos") - reach) / size), F.lit(0)).cast("int")
    hi = F.least(F.floor((F.col("pos") + reach) / size), last).cast("int")
    shown = rows.withColumn("ordinal", F.explode(F.sequence(lo, hi)))
    begin = F.col("ordinal") * size
    end = F.least(begin + size, F.col("rows_in_source"))
    shown = shown.where((F.col("pos") >= begin - reach) & (F.col("pos") < end + reach))
    return shown.withColumn("role", F.when(F.floor(F.col("pos") / size) == F.col("ordinal"), "target").otherwise("context_only"))


def payloads(shown: DataFrame, source: str, *fields: str) -> DataFrame:
    """One row for each batch with its items in order, as an array of structs."""
    item = F.struct("pos", "role", *fields)
    return shown.groupBy(source, "ordinal").agg(F.array_sort(F.collect_list(item)).alias("items"))
