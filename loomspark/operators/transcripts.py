"""Transcript correction as tables: timeline rows, checks of proposals, outcomes, change log, failure gate."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions.text import casefolded, collapse_whitespace, compact, normalize_transcript, similarity
from loomspark.operators.review import outcome, safe_change
from loomspark.operators.timeline import NO_START

# Fixed values.
BACKENDS = {"speech": "grok-stt", "nonverbal": "faster-whisper"}


def finite(value: Column, fallback: Column) -> Column:
    """A number, or the fallback for null, text that is none, NaN and infinity."""
    number = value.try_cast("double")
    fine = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != F.lit(float("inf")))
    return F.when(fine, number).otherwise(fallback)


def source_uid(uid: Column, path: Column) -> Column:
    """The uid, else ``path:`` and the case-folded path with forward slashes; a row with neither fails the job."""
    named = F.nullif(F.trim(uid), F.lit(""))
    by_path = F.nullif(F.trim(path), F.lit(""))
    nameless = F.raise_error(F.lit("a row needs a source uid or a path")).cast("string")
    return F.when(named.isNotNull(), named).when(by_path.isNotNull(), F.concat(F.lit("path:"), casefolded(F.replace(by_path, F.lit("\\"), F.lit("/"))))).otherwise(nameless)


def timeline_rows(speech: DataFrame, nonverbal: DataFrame) -> DataFrame:
    """One row (kind, id, source_uid, start, end, backend, text) for each clip with text, of both streams.

    Both: id, row_index, source_uid, start, end. speech: asr_text_raw, text, asr_backend. nonverbal:
    transcript_text_raw, transcript_text, transcript_backend. A missing start goes behind all others, in row order.
    """

    def stream(df: DataFrame, kind: str, raw: Column, backend: str) -> DataFrame:
        start = finite(F.col("start"), F.lit(NO_START) + F.col("row_index"))
        return df.select(
            F.lit(kind).alias("kind"), F.trim(F.col("id").cast("string")).alias("id"), "source_uid", start.alias("start"), finite(F.col("end"), start).alias("end"),
            F.coalesce(F.nullif(F.col(backend), F.lit("")), F.lit(BACKENDS[kind])).alias("backend"), collapse_whitespace(F.coalesce(raw, F.lit(""))).alias("text"),
        )

    both = stream(speech, "speech", F.coalesce("asr_text_raw", "text"), "asr_backend").unionByName(
        stream(nonverbal, "nonverbal", F.coalesce("transcript_text_raw", "transcript_text"), "transcript_backend")
    )
    return both.where("text <> ''")


def check_proposals(targets: DataFrame, proposals: DataFrame, statuses: list[str], categories: list[str]) -> DataFrame:
    """Problems of proposals by id: missing, unexpected, duplicate, bad_status, bad_category. No row means valid."""
    seen = proposals.groupBy("id").agg(F.count("*").alias("n"), F.first("status").alias("status"), F.first("category").alias("category"))
    both = targets.select("id", F.lit(True).alias("t")).join(seen, "id", "full_outer")
    problem = (
        F.when(F.col("n").isNull(), "missing").when(F.col("t").isNull(), "unexpected").when(F.col("n") > 1, "duplicate")
        .when(~F.coalesce(F.col("status").isin(statuses), F.lit(False)), "bad_status").when(~F.coalesce(F.col("category").isin(categories), F.lit(False)), "bad_category")
    )
    return both.select("id", problem.alias("problem")).where("problem is not null")


def resolve(timeline: DataFrame, proposals: DataFrame) -> DataFrame:
    """timeline with outcome, final text, and what the change was judged by; a left join, so every item keeps a row.

    proposals: id, corrected_text, status, category. Category is speech by default; other forces review for the speech stream.
    A proposal is normalized first. A change is safe if similarity and length ratio of the compact texts, and the raw length
    ratio, are in bounds; similarity and length_ratio are 1 where no change was judged.
    """
    made = proposals.select("id", normalize_transcript(F.col("corrected_text")).alias("after"), F.col("corrected_text").alias("suggested"), F.col("status").alias("proposed"), F.col("category").alias("proposed_category"), F.lit(True).alias("found"))
    rows = timeline.join(made, "id", "left")
    rows = rows.withColumn("compact_before", compact("text")).withColumn("compact_after", compact("after"))
    rows = rows.withColumn("ratio", similarity("compact_before", "compact_after"))
    safe = safe_change(F.length("text"), F.length("after"), F.length("compact_before"), F.length("compact_after"), F.col("ratio"))
    rows = rows.withColumn("outcome", outcome(F.col("found"), F.col("proposed"), F.col("text"), F.col("after"), safe))
    judged = F.col("outcome").isin("accepted", "rejected_unsafe")
    lengths = F.length("compact_after") / F.greatest(F.length("compact_before"), F.lit(1))
    forced = (F.coalesce(F.col("proposed_category"), F.lit("speech")) == "other") & (F.col("kind") == "speech")
    return rows.select(
        *timeline.columns, "outcome", F.when(F.col("outcome") == "accepted", F.col("after")).otherwise(F.col("text")).alias("final_text"),
        F.coalesce("proposed_category", F.lit("speech")).alias("category"), forced.alias("force_review"), "suggested", "proposed",
        F.when(judged, F.bround("ratio", 6)).otherwise(1.0).alias("similarity"), F.when(judged, F.bround(lengths, 6)).otherwise(1.0).alias("length_ratio"),
    )


def corrected_rows(clips: DataFrame, resolved: DataFrame) -> DataFrame:
    """Speech clips (id, text, status, review_reasons, ...) with their outcome: text, category, and review for category other.

    Clips that the timeline lacks (without text) stay untouched.
    """
    own = resolved.where("kind = 'speech'").select("id", F.col("text").alias("__raw"), "final_text", F.col("category").alias("__category"), "force_review", "outcome")
    rows = clips.join(own, "id", "left")
    forced, seen = F.coalesce("force_review", F.lit(False)), F.col("outcome").isNotNull()
    reasons = F.coalesce("review_reasons", F.array().cast("array<string>"))
    new = {
        "text": F.coalesce("final_text", "text"), "asr_text_raw": F.col("__raw"), "correction": F.col("outcome"),
        "status": F.when(forced, "review").otherwise(F.col("status")), "review_reasons": F.when(forced, F.array_union(reasons, F.array(F.lit("llm_category_other")))).otherwise(F.col("review_reasons")),
        "category": F.when(seen, F.col("__category")).otherwise(F.col("category") if "category" in clips.columns else F.lit(None)),
    }
    kept = [c for c in clips.columns if c not in new]
    return rows.select(*kept, *[v.alias(c) for c, v in new.items()])


def change_log(resolved: DataFrame) -> DataFrame:
    """Accepted, rejected and uncertain proposals: id, kind, source, times, outcome, text before and after, what was suggested, and the figures."""
    changed = resolved.where("outcome in ('accepted', 'rejected_unsafe', 'uncertain')")
    return changed.select("id", "kind", "source_uid", "start", "end", "outcome", F.col("text").alias("before"), F.col("final_text").alias("after"), "suggested", "similarity", "length_ratio", "category")


def correction_summary(resolved: DataFrame, batches: DataFrame) -> DataFrame:
    """One row: segments and their outcomes, batches and how many failed. batches: status (ok or failed)."""
    counts = [F.count_if(F.col("outcome") == o).alias(o) for o in ("accepted", "unchanged", "uncertain", "rejected_unsafe", "missing")]
    audit = batches.agg(F.count("*").alias("batches"), F.count_if(F.col("status") == "ok").alias("batches_completed"), F.count_if(F.col("status") == "failed").alias("batches_failed"))
    return resolved.agg(F.count("*").alias("timeline_segments"), *counts).join(audit)  # one row each


def answered(batches: DataFrame, agents: list[tuple[str, Callable[[str], str]]], attempts: int = 2, source: str = "source_uid", payload: str = "payload") -> DataFrame:
    """(source, ordinal, status, agent, attempt, result, error) of each batch: the first answer of the agents, in order of preference.

    Each agent has so many attempts; a batch that none answers is failed with the last error, and stops no other. Calls run in the
    tasks that hold the batches.
    """
    kind = batches.schema[source].dataType.simpleString()

    def one(text: str) -> tuple:
        error = "no agent"
        for name, call in agents:
            for attempt in range(1, attempts + 1):
                try:
                    return "ok", name, attempt, call(text), None
                except Exception as e:  # what an agent raises is its answer
                    error = f"{name}: {e}"
        return "failed", None, len(agents) * attempts, None, error

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = [(key, int(n), *one(text)) for key, n, text in zip(part[source], part["ordinal"], part[payload])]
            yield pd.DataFrame(rows, columns=[source, "ordinal", "status", "agent", "attempt", "result", "error"])

    return batches.select(source, "ordinal", payload).mapInPandas(run, f"{source} {kind}, ordinal int, status string, agent string, attempt int, result string, error string")


def refuse_failures(batches: DataFrame, allow: bool = False) -> None:
    """Raises if a batch failed, unless that is allowed."""
    failed = batches.where("status = 'failed'").count()
    if failed and not allow:
        raise ValueError(f"{failed} batches failed; nothing is published")
