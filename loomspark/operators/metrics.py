"""Metric roll-ups: conditional groups, weighted means, running figures, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def conditional_means(values: dict[str, Column], speaker: Column, caption: Column) -> list[Column]:
    """Means and counts of each value in the eight groups of two flags; 0 for an empty group.

    A null flag is in none of its groups, nor in their negations.
    """
    groups = {
        "speaker": speaker, "no_speaker": ~speaker, "caption": caption, "no_caption": ~caption,
        "speaker_caption": speaker & caption, "speaker_only": speaker & ~caption, "caption_only": ~speaker & caption, "neither": ~speaker & ~caption,
    }
    out = []
    for name, test in groups.items():
        n = F.count_if(test)
        out.append(n.alias(f"n_{name}"))
        for what, value in values.items():
            out.append(F.round(F.coalesce(F.sum(F.when(test, value)) / F.nullif(n, F.lit(0)), F.lit(0.0)), 6).alias(f"{what}_{name}"))
    return out


def weighted_mean(value: Column, weight: Column) -> Column:
    """Sum of value * weight over the sum of weights, which counts as 1 at least."""
    return F.sum(value * weight) / F.greatest(F.sum(weight).cast("double"), F.lit(1.0))


def trailing_mean(value: Column, keys: list[str], order: list[str], rows: int = 20) -> Column:
    """Mean of the last rows, this one included."""
    return F.avg(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(1 - rows, 0))


def ema(value: Column, back: Column, first: Column, decay: float) -> Column:
    """Aggregate: exponential moving average, from the first value on, as a weighted sum; so it is not a fold in one task.

    back: how many values follow; first: the back of the first value. The first weighs decay**back, the others 1 - decay as much.
    """
    return F.sum(value.cast("double") * F.pow(F.lit(decay), back) * F.when(back == first, 1.0).otherwise(1.0 - decay))


def rate(step: Column, seconds: Column, keys: list[str], order: list[str], batch: int) -> Column:
    """Items a second since the row before."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return (step - F.lag(step).over(window)) * batch / (seconds - F.lag(seconds).over(window))


def keep_latest(df: DataFrame, keys: list[str], step: str, n: int) -> DataFrame:
    """The n rows with the highest step of each key."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(step)))
    return df.withColumn("__k", place).where(F.col("__k") <= n).drop("__k")


def keep_best(df: DataFrame, keys: list[str], score: str, step: str, n: int, written: str | None = None) -> DataFrame:
    """The n rows with the lowest score of each key, the older first on ties. Of rows with one step the last written counts."""
    if written:
        again = F.row_number().over(Window.partitionBy(*keys, step).orderBy(F.desc(written)))
        df = df.withColumn("__w", again).where("__w = 1").drop("__w")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(score, step))
    return df.withColumn("place", place).where(F.col("place") <= n)


def huber(error: Column, delta: float) -> Column:
    """Squared near zero, linear beyond delta."""
    size = F.abs(error)
    return F.when(size <= delta, 0.5 * error * error).otherwise(delta * (size - 0.5 * delta))


def frame_error(predicted_log1p: Column, frames: Column) -> Column:
    """Distance of a predicted length from the true one."""
    return F.abs(F.expm1(predicted_log1p) - frames)
