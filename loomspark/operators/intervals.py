"""Interval operators on rows (key, start, end): complement, midpoint cut, packing, sessions, runs, peaks.

Folds are the only sequential parts. They run on arrays cut at boundaries that no fold can cross (a gap
beyond the limit from everything before), so a key with very many rows is folded in many small pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEFORE = (Window.unboundedPreceding, -1)


def complement(rows: DataFrame, keys: list[str], limits: DataFrame, minimum: float) -> DataFrame:
    """Parts of [0, limit] of each key that no interval covers, at least `minimum` long.

    limits: keys and limit. Keys without intervals give one gap, the whole.
    """
    window = Window.partitionBy(*keys).orderBy("start", "end").rowsBetween(*BEFORE)
    zero = F.lit(0).cast(rows.schema["end"].dataType)
    reach = F.greatest(F.coalesce(F.max("end").over(window), zero), zero)
    inner = rows.withColumn("gap_start", reach).where(F.col("start") - F.col("gap_start") >= minimum).select(*keys, "gap_start", F.col("start").alias("gap_end"))
    ends = rows.groupBy(*keys).agg(F.max("end").alias("last"))
    tail = limits.join(ends, keys, "left").select(*keys, F.greatest(F.coalesce("last", zero), zero).alias("gap_start"), F.col("limit").alias("gap_end"))
    return inner.unionByName(tail.where(F.col("gap_end") - F.col("gap_start") >= minimum))


def midpoint_cut(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Neighbours that overlap are cut at the middle of the overlap; exact with lag and lead, since each cut reads values from before any cut."""
    window = Window.partitionBy(*keys).orderBy(*order)
    last_end, next_start = F.lag("end").over(window), F.lead("start").over(window)
    return rows.select(
        "*",
        F.when(last_end > F.col("start"), (last_end + F.col("start")) / 2).otherwise(F.col("start")).alias("cut_start"),
        F.when(F.col("end") > next_start, (F.col("end") + next_start) / 2).otherwise(F.col("end")).alias("cut_end"),
    )


def split_long(rows: DataFrame, cap: int) -> DataFrame:
    """Intervals longer than the cap become pieces of it and a rest; empty intervals go."""
    pieces = F.sequence(F.lit(0), F.greatest(F.ceil((F.col("end") - F.col("start")) / F.lit(cap)) - 1, F.lit(0)))
    at = F.col("start") + F.col("piece") * F.lit(cap)
    return rows.where("end > start").withColumn("piece", F.explode(pieces)).select(
        *[c for c in rows.columns if c not in ("start", "end")], at.alias("start"), F.least(at + F.lit(cap), F.col("end")).alias("end")
    )


def islands(rows: DataFrame, keys: list[str], max_gap: float) -> DataFrame:
    """rows with an `island` number that grows where start is more than max_gap after all ends before."""
    window = Window.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(window.rowsBetween(*BEFORE))
    fresh = F.when(reach.isNull() | (F.col("start") - reach > max_gap), 1).otherwise(0)
    return rows.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(window.rowsBetween(Window.unboundedPreceding, 0))).drop("fresh")


def pack(rows: DataFrame, keys: list[str], cap: int, max_gap: int) -> DataFrame:
    """Greedy packing: an interval joins the running one if the gap is at most max_gap and the interval's end lies at most cap after the running start.

    Both limits are inclusive; longer intervals are split first. Returns keys, start, end, parts.
    """
    cut = islands(split_long(rows, cap), keys, max_gap)
    pieces = cut.groupBy(*keys, "island").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("parts"))

    def step(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        joins = (F.size(acc) > 0) & (F.greatest(x["start"] - F.get(acc, F.size(acc) - 1)["end"], F.lit(0)) <= max_gap) & (x["end"] - F.get(acc, F.size(acc) - 1)["start"] <= cap)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"), (last["parts"] + 1).alias("parts"))
        fresh = F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(1).cast("long").alias("parts"))
        return F.when(joins, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(grown))).otherwise(F.concat(acc, F.array(fresh)))

    empty = F.array().cast("array<struct<start:bigint,end:bigint,parts:bigint>>")
    return pieces.select(*keys, F.explode(F.aggregate("parts", empty, step)).alias("p")).select(*keys, "p.start", "p.end", "p.parts")


def pack_events(rows: DataFrame, keys: list[str], max_span: int, minimum: int, slack: int) -> DataFrame:
    """Contiguous pieces (start within slack of the end before) join up to max_span; results of at least `minimum` stay.

    A piece longer than max_span gives chunks of it, whatever the minimum, and its rest goes on. Returns keys, start, end.
    """
    window = Window.partitionBy(*keys).orderBy("start", "end")
    last = F.lag("end").over(window)
    fresh = F.when(last.isNull() | (F.abs(F.col("start") - last) > slack), 1).otherwise(0)
    run = rows.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(window.rowsBetween(Window.unboundedPreceding, 0)))
    parts = run.groupBy(*keys, "run").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("parts"))
    kind = "struct<done:array<struct<start:bigint,end:bigint>>,start:bigint,end:bigint>"

    def flushed(acc: Column) -> Column:
        keep = acc["start"].isNotNull() & (acc["end"] - acc["start"] >= minimum)
        return F.when(keep, F.concat(acc["done"], F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end"))))).otherwise(acc["done"])

    def step(acc: Column, x: Column) -> Column:
        joins = acc["start"].isNotNull() & (x["end"] - acc["start"] <= max_span)
        whole = F.greatest(F.ceil((x["end"] - x["start"]) / F.lit(max_span)) - 1, F.lit(0))
        chunks = F.transform(
            F.filter(F.sequence(F.lit(0).cast("long"), whole), lambda i: i < whole),
            lambda i: F.struct((x["start"] + i * max_span).alias("start"), (x["start"] + (i + 1) * max_span).alias("end")),
        )
        joined = F.struct(acc["done"].alias("done"), acc["start"].alias("start"), x["end"].alias("end"))
        begun = F.struct(F.concat(flushed(acc), chunks).alias("done"), (x["start"] + whole * max_span).alias("start"), x["end"].alias("end"))
        return F.when(joins, joined).otherwise(begun).cast(kind)

    begin = F.struct(F.array().cast("array<struct<start:bigint,end:bigint>>").alias("done"), F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("end")).cast(kind)
    return parts.select(*keys, F.explode(F.aggregate("parts", begin, step, flushed)).alias("p")).select(*keys, "p.start", "p.end")


def segment(rows: DataFrame, keys: list[str], limits: DataFrame, longest: int, shortest: int, padding: int, join_gap: int) -> DataFrame:
    """Packed, padded and non-overlapping spans: the cap leaves room for padding, pads are clipped to [0, limit], overlaps are cut at the middle."""
    packed = pack(rows, keys, max(shortest, longest - 2 * padding), join_gap).join(limits, keys)
    padded = packed.select(*keys, F.greatest(F.col("start") - padding, F.lit(0)).alias("start"), F.least(F.col("end") + padding, F.col("limit")).alias("end"))
    return midpoint_cut(padded, keys, ["start", "end"]).select(*keys, F.col("cut_start").alias("start"), F.col("cut_end").alias("end"))


def quiet_runs(frames: DataFrame, keys: list[str], quiet: Column, least: int) -> DataFrame:
    """Runs of at least `least` consecutive quiet frames: keys, first, last, lowest (frame of least rms, first on ties).

    frames: keys, idx, rms.
    """
    window = Window.partitionBy(*keys).orderBy("idx")
    run = frames.where(quiet).withColumn("run", F.col("idx") - F.row_number().over(window))
    found = run.groupBy(*keys, "run").agg(F.min("idx").alias("first"), F.max("idx").alias("last"), F.min_by("idx", F.struct("rms", "idx")).alias("lowest"))
    return found.where(F.col("last") - F.col("first") + 1 >= least).drop("run")


def local_peaks(frames: DataFrame, keys: list[str], radius: int, threshold: Column) -> DataFrame:
    """Frames at least as high as all within the radius (up to 1e-8) and above the threshold. frames: keys, idx, value."""
    window = Window.partitionBy(*keys).orderBy("idx").rowsBetween(-radius, radius)
    return frames.withColumn("top", F.max("value").over(window)).where((F.col("value") >= F.col("top") - 1e-8) & (F.col("value") >= threshold)).drop("top")


def smoothed_mean(frames: DataFrame, keys: list[str], kernel: int) -> DataFrame:
    """Centred mean over an odd kernel with edge values repeated; a kernel is cut to 2 n - 1. frames: keys, idx from 0, value."""
    own = Window.partitionBy(*keys)
    order = own.orderBy("idx")
    n = F.count("*").over(own)
    half = F.least(F.lit(kernel // 2), n - 1)
    frame = order.rowsBetween(-(kernel // 2), kernel // 2)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.greatest(half - F.col("idx"), F.lit(0)) * F.first("value").over(whole)
    right = F.greatest(F.col("idx") + half - (n - 1), F.lit(0)) * F.last("value").over(whole)
    return frames.withColumn("smooth", (F.sum("value").over(frame) + left + right) / (2 * half + 1))


def smoothed_max(frames: DataFrame, keys: list[str], kernel: int) -> DataFrame:
    """Centred maximum over an odd kernel; repeated edge values change nothing. frames: keys, idx, value."""
    around = Window.partitionBy(*keys).orderBy("idx").rowsBetween(-(kernel // 2), kernel // 2)
    return frames.withColumn("smooth", F.max("value").over(around))


def cosine_novelty(frames: DataFrame, keys: list[str], context: int, spectrum: str = "spectrum") -> DataFrame:
    """frames (keys, idx from 0, an array) with `novelty`: 1 less the cosine of the mean spectra before and from each frame on; 0 near the ends.

    Bins are rows while the means are taken, so a mean is a window over numbers.
    """
    own = Window.partitionBy(*keys)
    sized = frames.withColumn("__n", F.count("*").over(own))
    order = Window.partitionBy(*keys, "__bin").orderBy("idx")
    bins = sized.select(*keys, "idx", "__n", F.posexplode(spectrum).alias("__bin", "__v"))
    means = bins.select(*keys, "idx", "__n", F.avg("__v").over(order.rowsBetween(-context, -1)).alias("l"), F.avg("__v").over(order.rowsBetween(0, context - 1)).alias("r"))
    inside = (F.col("idx") >= context) & (F.col("idx") < F.col("__n") - context)
    size = lambda c: F.greatest(F.sqrt(F.sum(F.col(c) * F.col(c))), F.lit(1e-8))
    novelty = means.where(inside).groupBy(*keys, "idx").agg((1 - F.sum(F.col("l") * F.col("r")) / (size("l") * size("r"))).alias("novelty"))
    return frames.join(novelty, [*keys, "idx"], "left").withColumn("novelty", F.coalesce("novelty", F.lit(0.0)))


def collapsed_peaks(peaks: DataFrame, keys: list[str], radius: int) -> DataFrame:
    """Of peaks within the radius of the last kept one, the higher stays (the earlier, up to 1e-9). peaks: keys, idx, value.

    Peaks further apart than the radius never meet, so the fold runs on runs of near peaks.
    """
    window = Window.partitionBy(*keys).orderBy("idx")
    fresh = F.when(F.coalesce(F.col("idx") - F.lag("idx").over(window), F.lit(radius + 1)) > radius, 1).otherwise(0)
    runs = peaks.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(window.rowsBetween(Window.unboundedPreceding, 0)))
    parts = runs.groupBy(*keys, "run").agg(F.array_sort(F.collect_list(F.struct(F.col("idx").cast("int").alias("idx"), F.col("value").cast("double").alias("value")))).alias("parts"))

    def step(acc: Column, x: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        far = (F.size(acc) == 0) | (x["idx"] - last["idx"] > radius)
        higher = x["value"] > last["value"] + 1e-9
        swapped = F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(x))
        return F.when(far, F.concat(acc, F.array(x))).when(higher, swapped).otherwise(acc)

    empty = F.array().cast("array<struct<idx:int,value:double>>")
    return parts.select(*keys, F.explode(F.aggregate("parts", empty, step)).alias("p")).select(*keys, "p.idx", "p.value")


def context_step(frames: DataFrame, keys: list[str], context: int) -> DataFrame:
    """frames (keys, idx from 0, value) with `step`: the distance of the means over `context` frames before and from each frame on; 0 near the ends."""
    own = Window.partitionBy(*keys)
    order = own.orderBy("idx")
    left, right = F.avg("value").over(order.rowsBetween(-context, -1)), F.avg("value").over(order.rowsBetween(0, context - 1))
    inside = (F.col("idx") >= context) & (F.col("idx") < F.count("*").over(own) - context)
    return frames.withColumn("step", F.when(inside, F.abs(left - right)).otherwise(F.lit(0.0)))


def positive_flux(frames: DataFrame, keys: list[str], spectrum: str = "spectrum") -> DataFrame:
    """frames (keys, idx, an array) with `flux`: the length of the growth since the frame before; 0 for the first."""
    last = F.lag(spectrum).over(Window.partitionBy(*keys).orderBy("idx"))
    growth = F.zip_with(F.col(spectrum), last, lambda a, b: F.greatest(a.cast("double") - b.cast("double"), F.lit(0.0)))
    return frames.withColumn("flux", F.coalesce(F.sqrt(F.aggregate(growth, F.lit(0.0), lambda s, v: s + v * v)), F.lit(0.0)))
