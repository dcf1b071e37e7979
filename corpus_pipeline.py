"""From documents to token ids: toxic documents go, spreading lines go, one of each group of near copies
stays, documents with benchmark passages go, and what is left is encoded.

Each stage is one operator of ``loomspark.llm`` with the parameters of its registered query, applied to all
that its predecessor kept; near copies have a similarity of their own (``near_copies``).

Awkward rows: a null or empty text is kept by every stage as long as it is alone (texts without words are near copies of
each other), has no tokens and decodes to itself. Rows with a null id are judged by their text alone; they are never near
copies of others, and own a line only if no row with an id has it. Rows that repeat both id and text become one, rows that share only
the id are documents of their own. Very long texts are read whole. Extra columns pass through all stages but the last.
Empty documents give an empty result; without labels nothing is toxic, without a benchmark nothing leaks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.llm import decontamination, line_dedup, near_copies, queries, sentencepiece_codec, toxicity
from loomspark.llm.common import materialize
from loomspark.session import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity bound. The machine learns from labels that are not held out."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model, queries.TOXIC_AT)


def drop_spread_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that other documents own; n_chars is counted again."""
    cleaned = line_dedup.drop_spread_lines(docs, min_sites=queries.MIN_SITES).drop("removed_lines")
    return cleaned.withColumn("n_chars", F.length("text").cast("long"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: SimHash tables on five-word shingles, verified Jaccard similarity of 0.8 or more."""
    return near_copies.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, their number, and whether they decode to the text."""
    carried = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    coded = sentencepiece_codec.encode_decode(carried, queries.tokenizer_path("piece_bpe_32k.model"), keep_text=True)
    mark = F.translate("text", sentencepiece_codec.MARK, " ")  # the word mark itself decodes to a space
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == mark).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_spread_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("sentencepiece", encode),
]

#: SQL can't express the first stage; the stages are tested one by one instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
