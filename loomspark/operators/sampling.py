"""Seeded splits, balanced draws, length buckets and pairings.

Order comes from a hash of (seed, id), so each choice is a function of the row and repeats anywhere. Ranks
over a whole table are cut by two-level counting, never by sorting it in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw(seed: int | str, key: Column) -> Column:
    """A portable order key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


#: Rows of a bucket that are numbered in one task, and hexadecimal digits that name a bucket at most (65,536 buckets).
BUCKET_ROWS, MOST_DIGITS = 100_000, 4


def bucket_digits(rows: int) -> int:
    """Leading hexadecimal digits of a hash that deal so many rows into buckets of bounded size."""
    digits = 2
    while digits < MOST_DIGITS and rows > BUCKET_ROWS * 16**digits:
        digits += 1
    return digits


def ranked(df: DataFrame, order: list[Column], bucket: Column, buckets: int = 256) -> DataFrame:
    """df with `pos`, the place (from 0) in a total order of which `bucket` is a monotone coarse part (0 to buckets-1).

    Rows are numbered within buckets; offsets come from a table of `buckets` counts, so there should be more of them the
    more rows there are (:func:`bucket_digits`).
    """
    cut = df.withColumn("__b", bucket.cast("int"))
    counts = cut.groupBy("__b").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(counts.select("__b", before.alias("__o")))  # one row a bucket
    place = F.row_number().over(Window.partitionBy("__b").orderBy(*order))
    return cut.withColumn("__k", place).join(offsets, "__b").withColumn("pos", F.col("__o") + F.col("__k") - 1).drop("__b", "__o", "__k")


def shuffled(df: DataFrame, key: str, seed: int) -> DataFrame:
    """df with `pos`, its place in a seeded permutation."""
    digits = bucket_digits(df.count())
    bucket = F.conv(F.substring("__d", 1, digits), 16, 10)
    return ranked(df.withColumn("__d", draw(seed, F.col(key))), [F.col("__d"), F.col(key)], bucket, 16**digits).drop("__d")


def row_split(df: DataFrame, key: str, ratio: float, seed: int) -> DataFrame:
    """df with `part`: exactly max(1, floor(n * ratio)) rows, at most n - 1, are valid; the others train."""
    n = df.count()
    size = min(max(1, int(n * ratio)), n - 1)
    return shuffled(df, key, seed).withColumn("part", F.when(F.col("pos") < size, "valid").otherwise("train")).drop("pos")


def group_split(df: DataFrame, key: str, group: str, ratio: float, seed: int) -> DataFrame:
    """df with `part`: whole groups are valid, in seeded order, until the target is reached.

    A group that would leave no training row is passed over. Rows without a group are groups of one.
    Sizes before each group come from bucket totals and running sums within buckets. Only groups larger than all that
    may stay out of the valid part (fewer than 1 / (1 - ratio)) can be passed over; the driver decides on those alone.
    """
    if not 0 < ratio <= 0.99:
        raise ValueError("the ratio must be over 0 and at most 0.99")
    n = df.count()
    target = min(max(1, int(n * ratio)), n - 1)
    name = F.coalesce(F.concat(F.lit("g"), F.col(group).cast("string")), F.concat(F.lit("r"), F.col(key).cast("string")))
    tagged = df.withColumn("__g", name)
    sizes = tagged.groupBy("__g").agg(F.count("*").alias("size")).withColumn("__d", draw(seed, F.col("__g")))
    usual = sizes.where(F.col("size") <= n - target)
    taken: list[tuple[str, str, int]] = []
    for big in sizes.where(F.col("size") > n - target).orderBy("__d", "__g").collect():
        at = (F.col("__d") < big["__d"]) | ((F.col("__d") == big["__d"]) & (F.col("__g") < big["__g"]))
        before = (usual.where(at).agg(F.sum("size")).first()[0] or 0) + sum(s for _, _, s in taken)
        if before < target and before + big["size"] <= n - 1:
            taken.append((big["__d"], big["__g"], big["size"]))

    cut = usual.withColumn("__b", F.conv(F.substring("__d", 1, 3), 16, 10).cast("int"))
    totals = cut.groupBy("__b").agg(F.sum("size").alias("n"))
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(totals.select("__b", earlier.alias("__o")))  # 4096 rows at most
    within = F.coalesce(F.sum("size").over(Window.partitionBy("__b").orderBy("__d", "__g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = F.col("__o") + F.col("__w")
    for d, _, size in taken:
        before = before + F.when(F.col("__d") > d, F.lit(size)).otherwise(F.lit(0))
    picked = cut.withColumn("__w", within).join(offsets, "__b").where(before < target).select("__g", F.lit(True).alias("__v"))
    if taken:
        picked = picked.unionByName(df.sparkSession.createDataFrame([(g, True) for _, g, _ in taken], "__g string, __v boolean"))
    return tagged.join(picked, "__g", "left").withColumn("part", F.when(F.col("__v"), "valid").otherwise("train")).drop("__g", "__v")


def balanced(df: DataFrame, key: str, category: str, seed: int, epoch: int = 0) -> DataFrame:
    """Every category cut to the size of the smallest, without replacement, drawn anew each epoch; null is a category.

    Rows are drawn by the order of a hash. Counts of its leading digits tell in which bucket a category's last drawn row
    lies: buckets before it go in whole, and only that bucket's rows are numbered, so no task holds a category.
    """
    counts = df.groupBy(category).agg(F.count("*").alias("n"))
    least, most = counts.agg(F.min("n"), F.max("n")).first()
    digits = bucket_digits(most or 0)
    cut = df.withColumn("__d", draw(seed + epoch, F.col(key))).withColumn("__b", F.conv(F.substring("__d", 1, digits), 16, 10).cast("int"))
    sizes = cut.groupBy(F.col(category).alias("__c"), "__b").agg(F.count("*").alias("__n"))
    upto = F.sum("__n").over(Window.partitionBy("__c").orderBy("__b"))  # at most 16**digits rows a category
    quota = sizes.withColumn("__q", F.lit(least or 0) - (upto - F.col("__n"))).where("__q > 0").select("__c", F.col("__b").alias("__b2"), "__n", "__q")
    drawn = cut.join(quota, F.col(category).eqNullSafe(F.col("__c")) & (F.col("__b") == F.col("__b2")))
    whole = drawn.where("__q >= __n").select(*df.columns)
    place = F.row_number().over(Window.partitionBy("__c", "__b").orderBy("__d", key))
    last = drawn.where("__q < __n").withColumn("__k", place).where("__k <= __q").select(*df.columns)
    return whole.unionByName(last)


def length_batches(df: DataFrame, key: str, length: str, batch: int, windows: int, seed: int) -> DataFrame:
    """df with pos, window and batch: shuffled, cut into windows of batch * windows rows, sorted by length within, cut into batches."""
    span = batch * windows
    placed = shuffled(df, key, seed).withColumn("window", F.floor(F.col("pos") / F.lit(span)).cast("int"))
    within = F.row_number().over(Window.partitionBy("window").orderBy(length, "pos")) - 1
    return placed.withColumn("batch", (F.col("window") * windows + F.floor(within / F.lit(batch))).cast("long"))


def shuffled_batches(batches: DataFrame, batch: str, seed: int) -> DataFrame:
    """Batches (one row each) with `place`, their place in a seeded order."""
    return shuffled(batches.select(batch).distinct(), batch, seed).withColumnRenamed("pos", "place")


def style_pools(df: DataFrame, speaker: str, category: str) -> DataFrame:
    """Rows whose (speaker, category) pool has two rows or more; null speakers go, a null category is a category.

    Sizes are aggregated and joined, so that a large pool stays in many tasks.
    """
    rows = df.where(F.col(speaker).isNotNull())
    pools = rows.groupBy(F.col(speaker).alias("__s"), F.col(category).alias("__c")).agg(F.count("*").alias("__n")).where("__n >= 2")
    return rows.join(pools, (F.col(speaker) == F.col("__s")) & F.col(category).eqNullSafe(F.col("__c")), "left_semi")


def next_in_pool(df: DataFrame, key: str, pool: list[str]) -> DataFrame:
    """df with `reference`, the next row's key in its pool, the first one's for the last."""
    window = Window.partitionBy(*pool).orderBy(key)
    whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn("reference", F.coalesce(F.lead(key).over(window), F.first(key).over(whole)))


def replica_shards(df: DataFrame, replicas: int, total: int, drop_last: bool = False) -> DataFrame:
    """df (with pos) dealt to replicas in strides; a short end is cut, or filled with the first rows again."""
    size = total // replicas * replicas if drop_last else -(-total // replicas) * replicas
    kept = df.where(F.col("pos") < size)
    if size > total:
        again = df.where(F.col("pos") < size - total).withColumn("pos", F.col("pos") + total)
        kept = kept.unionByName(again)
    return kept.withColumn("replica", F.pmod("pos", F.lit(replicas)).cast("int"))


def weighted_pick(df: DataFrame, key: str, weight: str, picks: int, seed: int, buckets: int = 64) -> DataFrame:
    """One row a pick: key with probability proportional to weight, by exponential races (smallest -ln(u) / weight for each pick).

    Rows race within hash buckets first, in as many tasks, then the buckets' winners; it is rows times picks in all.
    """
    u = (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("pick").cast("string"), F.lit(":"), F.col(key).cast("string"))), 1, 12), 16, 10).cast("double") + 1) / F.lit(float(16**12))
    races = df.where(F.col(weight) > 0).withColumn("pick", F.explode(F.sequence(F.lit(0), F.lit(picks - 1)))).withColumn("t", -F.log(u) / F.col(weight))
    heats = races.groupBy("pick", F.pmod(F.xxhash64(key), F.lit(buckets)).alias("heat")).agg(F.min_by(F.struct("t", key), F.struct("t", key)).alias("w"))
    return heats.groupBy("pick").agg(F.min("w")[key].alias(key))


def excerpt_tries(picks: DataFrame, duration: str, seconds: float, seed: int) -> DataFrame:
    """Picks (index, attempt, key, duration) that an excerpt fits in, with its `offset`; the first attempts come first.

    A file must be over a second longer than the excerpt; the offset is drawn evenly, half a second from either end.
    """
    u = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("index").cast("string"), F.col("attempt").cast("string"))), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))
    fits = picks.where(F.col(duration) > seconds + 1.0)
    return fits.withColumn("offset", 0.5 + u * (F.col(duration) - seconds - 1.0))


def first_sounding(tries: DataFrame, indexes: DataFrame, rms: str, least: float = 1e-3) -> DataFrame:
    """One row for each index: its first attempt that sounds; an index without any is silent (null key), so that no draw fails."""
    heard = tries.where(F.col(rms) > least).groupBy("index").agg(F.min_by(F.struct("key", "offset"), "attempt").alias("w"))
    return indexes.select("index").distinct().join(heard, "index", "left").select("index", "w.key", "w.offset", F.col("w").isNull().alias("silent"))
