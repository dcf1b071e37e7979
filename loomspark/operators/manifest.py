"""Manifest operators: validated union with lineage, duplicates, sharding, ordered merge, cache joins, text replacement."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge(parts: dict[str, DataFrame], required: list[str], unique: list[str]) -> DataFrame:
    """Union of manifests by name, with the origin of each row.

    A missing required value fails the job when it runs, with the origin in the message. A non-empty unique
    value that occurs twice is refused at once: one aggregation over that column alone, so whole rows are never
    shuffled. Extra columns pass through; those that a part lacks are null.
    """
    if not parts:
        raise ValueError("no input")
    tagged = [df.withColumn("manifest", F.lit(name)) for name, df in parts.items()]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    for column in unique:
        copies = out.where(F.coalesce(F.col(column).cast("string"), F.lit("")) != "").groupBy(column).agg(F.count("*").alias("n"), F.collect_set("manifest").alias("where"))
        if found := copies.where("n > 1").limit(1).collect():
            raise ValueError(f"duplicate {column}: {found[0][column]} in {', '.join(sorted(found[0]['where']))}")
    for column in required:
        fine = F.col(column).isNotNull() & (F.col(column).cast("string") != "")
        out = out.withColumn(column, F.when(fine, F.col(column)).otherwise(F.raise_error(F.concat(F.lit(f"missing {column} in "), F.col("manifest"))).cast(out.schema[column].dataType)))
    return out


def duplicates(df: DataFrame, key: str, order: str) -> DataFrame:
    """Values that occur more than once: key, copies, first and last place.

    An aggregation rather than a window: each task reduces its own rows before the shuffle.
    """
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("copies"), F.min(order).alias("first_at"), F.max(order).alias("last_at")).where("copies > 1")


def stride_shard(order: Column, shards: int, start: int = 0) -> Column:
    """Shard of a row by its position: every shards-th row."""
    return F.pmod(order - start, F.lit(shards)).cast("int")


def contiguous_shard(order: Column, total: int, shards: int, start: int = 0) -> Column:
    """Shard of a row in slices of ceil(total / shards); the last shards may stay empty."""
    per = max(1, -(-(total - start) // shards))
    return F.floor((order - start) / F.lit(per)).cast("int")


def shard_bounds(total: int, shards: int) -> list[tuple[int, int]]:
    """(first, count) of each contiguous slice."""
    per = -(-total // shards)
    return [(min(total, r * per), max(0, min(total, (r + 1) * per) - r * per)) for r in range(shards)]


def restore_order(ids: DataFrame, shards: DataFrame, key: str, order: str) -> DataFrame:
    """Shard rows in the order of ids. A missing id fails the job; extra ids are left out; of repeated ids the last (by `seq`) wins."""
    if "seq" in shards.columns:
        shards = shards.withColumn("__k", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("seq")))).where("__k = 1").drop("__k", "seq")
    found = ids.select(key, order).join(shards.withColumn("__in", F.lit(True)), key, "left")
    checked = F.when(F.col("__in"), F.col(order)).otherwise(F.raise_error(F.concat(F.lit("missing id "), F.col(key).cast("string"))).cast(ids.schema[order].dataType))
    return found.withColumn(order, checked).drop("__in").orderBy(order)


def last_write_wins(log: DataFrame, key: str, seq: str) -> DataFrame:
    """Latest row of each key of an append-only log."""
    return log.withColumn("__k", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(seq)))).where("__k = 1").drop("__k")


def cache_split(rows: DataFrame, cache: DataFrame, key: str, stamp: Column) -> DataFrame:
    """rows with `hit`: the cache has the key with the same fingerprint and no error. cache: key, fingerprint, status, one row a key."""
    held = cache.where("status <> 'error'").select(key, F.col("fingerprint").alias("__stamp"), F.lit(True).alias("__held"))
    return rows.join(held, key, "left").withColumn("hit", F.coalesce(F.col("__held") & (F.col("__stamp") == stamp), F.lit(False))).drop("__stamp", "__held")


def replace_text(text: Column, transcript: Column, ok: Column, reasons: Column, kept_before: Column) -> dict[str, Column]:
    """Text, first text before replacement, and reasons, after a transcript came in; applying it twice changes nothing more."""
    good = F.coalesce(ok & (F.coalesce(transcript, F.lit("")) != ""), F.lit(False))
    return {
        "text": F.when(good, transcript).otherwise(text),
        "text_before_asr": F.when(good, F.coalesce(kept_before, text)).otherwise(kept_before),
        "review_reasons": F.when(good, reasons).otherwise(F.array_union(reasons, F.array(F.lit("aw_transcript_unusable")))),
    }


def namespaced_speaker(namespace: str, *parts: Column) -> Column:
    """Sanitized parts joined by ``__`` behind the namespace; null if all are empty."""
    joined = F.concat_ws("__", F.filter(F.array(*[F.coalesce(p, F.lit("")) for p in parts]), lambda x: x != ""))
    return F.when(joined != "", F.concat(F.lit(f"{namespace}:"), joined))


def name_group(name: Column, patterns: dict[str, str], otherwise: str) -> Column:
    """The first group whose pattern a name holds, for parameters by name (adapters, decayed or not)."""
    out = None
    for group, pattern in patterns.items():
        out = F.when(name.rlike(pattern), group) if out is None else out.when(name.rlike(pattern), group)
    return F.lit(otherwise) if out is None else out.otherwise(otherwise)


def work_of(speaker: Column) -> Column:
    """The first work code in a speaker id, upper-cased; the id itself if there is none."""
    return F.coalesce(F.nullif(F.upper(F.regexp_extract(speaker, r"(?i)RJ\d+", 0)), F.lit("")), speaker)


def set_difference(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Ids on one side only: key, problem (missing or unexpected)."""
    both = expected.select(key, F.lit(True).alias("e")).distinct().join(found.select(key, F.lit(True).alias("f")).distinct(), key, "full_outer")
    return both.where("e is null or f is null").select(key, F.when(F.col("f").isNull(), "missing").otherwise("unexpected").alias("problem"))


def skip_histogram(df: DataFrame, reason: str = "skip_reason") -> DataFrame:
    """Rows by reason, most frequent first, then by name."""
    return df.where(F.col(reason).isNotNull()).groupBy(reason).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), reason)
