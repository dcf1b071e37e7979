"""Preparing rows: skip reasons in their order, limits, and roll-ups of what was skipped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspark.functions.text import sanitize_id, strip
from loomspark.operators.manifest import namespaced_speaker
from loomspark.operators.sampling import ranked

# Fixed values.
AUDIO_SKIPS = ("audio_decode", "trimmed_empty", "prepare_error", "encode_error", "dataset_iter_error")


def optional(text: Column) -> Column:
    """Text without white space at its ends; null for none."""
    return F.nullif(strip(F.coalesce(text, F.lit(""))), F.lit(""))


def skip_reason(
    text: Column, decode_error: Column, sample_rate: Column, samples: Column, max_seconds: float | None = None, min_rate: int = 0, prepare_error: Column | None = None, encode_error: Column | None = None
) -> Column:
    """First reason to skip a row, else null: empty_text, audio_decode, low_sample_rate, trimmed_empty, prepare_error, encode_error.

    Errors are text, null for none. A minimum rate of 0 asks for none; a trim to max_seconds that leaves no sample skips.
    """
    left = samples if max_seconds is None else F.least(samples, F.floor(F.lit(float(max_seconds)) * sample_rate).cast("long"))
    out = F.when(optional(text).isNull(), "empty_text").when(decode_error.isNotNull(), "audio_decode")
    if min_rate > 0:
        out = out.when(sample_rate < min_rate, "low_sample_rate")
    if max_seconds is not None:
        out = out.when(left <= 0, "trimmed_empty")
    for error, name in ((prepare_error, "prepare_error"), (encode_error, "encode_error")):
        if error is not None:
            out = out.when(error.isNotNull(), name)
    return out


def prepared(df: DataFrame, reason: Column, text: str, caption: str | None = None, speakers: tuple[str, ...] = (), namespace: str = "") -> DataFrame:
    """df's idx, skip_reason, text, caption, id, source_uid, category, cluster_token and speaker_id, as a manifest row has them.

    Columns that df lacks are null; provenance columns are trimmed and null if empty; a row without speaker parts has no speaker.
    """
    own = lambda c: optional(F.col(c).cast("string")) if c in df.columns else F.lit(None).cast("string")
    parts = [sanitize_id(F.col(c).cast("string"), "") for c in speakers]
    speaker = namespaced_speaker(namespace, *parts) if parts else F.lit(None).cast("string")
    return df.select(
        "idx", reason.alias("skip_reason"), own(text).alias("text"), (own(caption) if caption else F.lit(None).cast("string")).alias("caption"),
        *[own(c).alias(c) for c in ("id", "source_uid", "category", "cluster_token")], speaker.alias("speaker_id"),
    )


def first_rows(df: DataFrame, order: str, most: int | None) -> DataFrame:
    """The first rows in order, before anything else is done; all without a limit."""
    return df if most is None else df.orderBy(order).limit(most)


def limited(df: DataFrame, order: str, most: int | None, reason: str = "skip_reason", buckets: int | None = None) -> DataFrame:
    """df with rows beyond the first `most` accepted ones (in order of a number) skipped as max_samples_limit.

    Earlier reasons stay. Accepted rows are numbered within ranges of the order, with offsets from the ranges' counts.
    """
    if most is None:
        return df
    accepted = df.where(F.col(reason).isNull())
    low, high, n = accepted.agg(F.min(order), F.max(order), F.count("*")).first()
    if not n or n <= most:
        return df
    buckets = buckets or max(1, min(65_536, n // 4096))
    bucket = F.floor((F.col(order) - F.lit(low)) * F.lit(buckets - 1) / F.lit(max(1, high - low)))
    placed = ranked(accepted, [F.col(order)], bucket, buckets)
    kept = placed.withColumn(reason, F.when(F.col("pos") >= most, "max_samples_limit")).drop("pos")
    return df.where(F.col(reason).isNotNull()).unionByName(kept)


def skip_rollup(df: DataFrame, reason: str = "skip_reason") -> DataFrame:
    """One row: seen, written, skipped_empty, skipped_audio (five reasons together), skipped_low_sr, skipped_max."""
    count = lambda *names: F.count_if(F.coalesce(F.col(reason).isin(*names), F.lit(False)))
    return df.agg(
        F.count("*").alias("seen"), F.count_if(F.col(reason).isNull()).alias("written"), count("empty_text").alias("skipped_empty"),
        count(*AUDIO_SKIPS).alias("skipped_audio"), count("low_sample_rate").alias("skipped_low_sr"), count("max_samples_limit").alias("skipped_max"),
    )


def transcription_summary(rows: DataFrame, cached: str = "cached", status: str = "status") -> DataFrame:
    """One row: rows, cached, ok, review, errors."""
    is_ = lambda value: F.count_if(F.col(status) == value)
    return rows.agg(F.count("*").alias("rows"), F.count_if(F.col(cached)).alias("cached"), is_("ok").alias("ok"), is_("review").alias("review"), is_("error").alias("errors"))


def finite_steps(df: DataFrame, value: str, keys: list[str], order: str) -> DataFrame:
    """df with `events`: how many finite values of the key there have been, this row included; other rows don't count."""
    fine = F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
    return df.withColumn("events", F.count_if(fine).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def total_hours(seconds: Column) -> Column:
    return F.coalesce(F.sum(seconds), F.lit(0.0)) / 3600.0
