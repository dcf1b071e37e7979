"""Pools of rows by speaker and category: members, subsets, references, works."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NO_CATEGORY = "__none__"


def subset(index: DataFrame, wanted: DataFrame, key: str = "idx") -> DataFrame:
    """Rows of the index that are wanted, once each; no wanted row, or one that isn't there, is an error."""
    asked = wanted.select(key).distinct()
    found = index.select(key, F.lit(True).alias("__in")).distinct()
    n, gone = asked.join(found, key, "left").agg(F.count("*"), F.sort_array(F.slice(F.collect_list(F.when(F.col("__in").isNull(), F.col(key))), 1, 8))).first() if asked.limit(1).count() else (0, [])
    if not n:
        raise ValueError("a subset needs one row at least")
    if gone:
        raise ValueError(f"rows out of range: {list(gone)}")
    return index.join(asked, key, "left_semi")


def style_filtered(index: DataFrame, speaker: str = "speaker_id", category: str = "category") -> DataFrame:
    """Rows with a speaker whose (speaker, category) pool has two rows or more; a null category is one.

    Pool sizes are aggregated and joined, so a large pool stays in many tasks. An empty result is an error.
    """
    rows = index.where(F.col(speaker).isNotNull())
    pools = rows.groupBy(F.col(speaker).alias("__s"), F.col(category).alias("__c")).agg(F.count("*").alias("__n")).where("__n >= 2")
    kept = rows.join(pools, (F.col(speaker) == F.col("__s")) & F.col(category).eqNullSafe(F.col("__c")), "left_semi")
    if not kept.limit(1).count():
        raise ValueError("no (speaker, category) pool has two rows")
    return kept


def members(index: DataFrame, keys: list[str], order: str) -> DataFrame:
    """keys, place (from 0) and the row's order key: the ordered list of each group as rows, since a group may be large."""
    return index.where(F.col(keys[0]).isNotNull()).select(*keys, order, (F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1).alias("place"))


def labelled(speaker: Column, caption: Column, frames: Column, most: int | None) -> list[Column]:
    """Counts of rows with speaker, with caption, and longer than the most frames."""
    long = F.count_if(frames > most) if most is not None else F.lit(0).cast("long")
    return [F.count("*").alias("rows"), F.count(speaker).alias("speakers"), F.count_if(caption).alias("captions"), long.alias("overlong")]


def picked_references(index: DataFrame, key: str, speaker: str, category: str, seed: int) -> DataFrame:
    """index with `reference`: another row of its pool, chosen evenly by a seeded hash of the row; null if there is none.

    The pool is (speaker, category); where that has no other row, the speaker's. Rows are numbered within each pool, the pick is
    a number, and a join finds its row; so the rows of a pool are never listed. Rows without a speaker have no reference.
    """
    own = Window.partitionBy(speaker, category)
    wide = Window.partitionBy(speaker)
    placed = index.where(F.col(speaker).isNotNull()).withColumns(
        {
            "__p": F.row_number().over(own.orderBy(key)) - 1, "__n": F.count("*").over(own),
            "__q": F.row_number().over(wide.orderBy(key)) - 1, "__m": F.count("*").over(wide),
        }
    )
    u = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 12), 16, 10).cast("long")
    narrow = F.col("__n") > 1
    size, place = F.when(narrow, F.col("__n")).otherwise(F.col("__m")), F.when(narrow, F.col("__p")).otherwise(F.col("__q"))
    pick = F.when(size > 1, F.pmod(place + 1 + F.pmod(u, size - 1), size))
    asked = placed.select("*", narrow.alias("__narrow"), pick.alias("__pick"))
    near = placed.select(F.col(speaker).alias("__s"), F.col(category).alias("__c"), F.col("__p").alias("__at"), F.col(key).alias("__near"))
    far = placed.select(F.col(speaker).alias("__s2"), F.col("__q").alias("__at2"), F.col(key).alias("__far"))
    found = asked.join(near, F.col("__narrow") & (F.col(speaker) == F.col("__s")) & F.col(category).eqNullSafe(F.col("__c")) & (F.col("__pick") == F.col("__at")), "left")
    found = found.join(far, ~F.col("__narrow") & (F.col(speaker) == F.col("__s2")) & (F.col("__pick") == F.col("__at2")), "left")
    found = found.select(*index.columns, F.coalesce("__near", "__far").alias("reference"))
    return found.unionByName(index.where(F.col(speaker).isNull()).withColumn("reference", F.lit(None).cast(index.schema[key].dataType)))


def work_code(speaker: Column, path: Column) -> Column:
    """The work code of a speaker, else of the path, else the speaker; null without a speaker."""
    code = lambda c: F.nullif(F.upper(F.regexp_extract(c, r"(?i)RJ\d+", 0)), F.lit(""))
    return F.when(F.coalesce(speaker, F.lit("")) != "", F.coalesce(code(speaker), code(path), speaker))


def fixed_references(manifest: DataFrame, categories: list[str], fallback: str, count: int, usable: Column | None = None, order: str = "line") -> DataFrame:
    """(work, category, speaker_id, latent_path, place): the first usable row of each work and category, for the first works.

    manifest: line, speaker_id, category, latent_path. Works count once they have a row of the fallback category, in the order
    of that row; a work's speaker is that of its first slot. Fewer works than asked for is an error. `usable`: whether a row's
    latent is there.
    """
    work = work_code(F.col("speaker_id"), F.col("latent_path"))
    rows = manifest.withColumn("work", work).where(F.col("work").isNotNull() & F.coalesce("category", F.lit("")).isin([*categories, fallback]))
    rows = rows.where(usable) if usable is not None else rows
    slots = rows.groupBy("work", F.coalesce("category", F.lit("")).alias("category")).agg(F.min(order).alias("line"), F.min_by("latent_path", order).alias("latent_path"), F.min_by("speaker_id", order).alias("own"))
    works = slots.groupBy("work").agg(F.min(F.when(F.col("category") == fallback, F.col("line"))).alias("first"), F.min_by("own", "line").alias("speaker_id")).where("first is not null")
    # Works in order: the smallest `count` first lines, no more rows than asked for.
    chosen = works.orderBy("first").limit(count).select("work", "first", "speaker_id")
    n = chosen.count()
    if n < count:
        raise ValueError(f"only {n} distinct usable references; {count} are asked for")
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("first")) - 1  # `count` rows
    return slots.join(F.broadcast(chosen.withColumn("place", place)), "work").select("work", "category", "speaker_id", "latent_path", "place")
