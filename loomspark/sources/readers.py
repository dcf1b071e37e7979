"""Sources: JSON-lines manifests, file discovery, dataset arguments, nested columns, sharded and indexed scans."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fixed values.
AUDIO_SUFFIXES = (".aac", ".flac", ".m4a", ".mp3", ".mp4", ".ogg", ".opus", ".wav", ".webm")


def read_manifest(spark: SparkSession, path: str | list[str], schema: StructType | str, strict: bool = True) -> DataFrame:
    """A JSON-lines manifest under a declared schema; blank lines are skipped, an absent key is null.

    strict: a line that is no object of the schema fails the job. Otherwise it comes back in `_corrupt_record`.
    """
    reader = spark.read.schema(schema)
    if strict:
        return reader.option("mode", "FAILFAST").json(path)
    wide = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.read.schema(StructType([*wide.fields]).add("_corrupt_record", "string")).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def discover(spark: SparkSession, root: str, suffixes: Sequence[str] = AUDIO_SUFFIXES, exclude: Sequence[str] = ()) -> DataFrame:
    """Files below root with one of the suffixes: path, relative_path, size_bytes, modified; without those below an excluded folder.

    Only file metadata is read. Order by `sort_key` (the lower-cased relative path) where order matters.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"))
    ends = "|".join(s.lstrip(".") for s in suffixes)
    files = files.where(F.lower("path").rlike(rf"\.({ends})$"))
    base = root.rstrip("/").removeprefix("file://")
    files = files.withColumn("relative_path", F.regexp_replace("path", rf"^(?:[a-z]+:/*)?(?=/)|^file:", ""))
    files = files.withColumn("relative_path", F.substring_index("relative_path", base + "/", -1))
    for folder in exclude:
        files = files.where(~F.startswith("relative_path", F.lit(folder.rstrip("/") + "/")))
    return files.withColumn("sort_key", F.lower("relative_path"))


def longer_than(sources: DataFrame, minimum: float, max_files: int | None = None, order: str = "sort_key") -> DataFrame:
    """Sources strictly longer than the minimum; with max_files the first of them in path order."""
    kept = sources.where(F.col("duration") > minimum)
    return kept.orderBy(order).limit(max_files) if max_files else kept


def parse_data_files(items: str | list[str] | None) -> str | list[str] | dict[str, str | list[str]] | None:
    """File arguments: one JSON literal, entries ``split=path,path``, or paths (a comma list in one entry).

    With a split in any entry all entries need one; paths behind a comma belong to the split before, unless they name their
    own. A split given twice collects its paths; a single path stays a string.
    """
    entries = [i.strip() for i in ([items] if isinstance(items, str) else items or []) if i.strip()]
    if not entries:
        return None
    if len(entries) == 1 and entries[0][0] in "[{":
        return json.loads(entries[0])
    if not any("=" in e for e in entries):
        paths = [p.strip() for p in entries[0].split(",") if p.strip()] if len(entries) == 1 else entries
        return paths[0] if len(paths) == 1 else paths
    out: dict[str, list[str]] = {}
    for entry in entries:
        split = None
        for part in filter(None, map(str.strip, entry.split(","))):
            name, eq, path = part.partition("=")
            split = name.strip() if eq else split
            path = path.strip() if eq else part
            if not split or not path:
                raise ValueError(f"every entry must be split=path: {entry!r}")
            out.setdefault(split, []).append(path)
    return {k: v[0] if len(v) == 1 else v for k, v in out.items()}


def load_dataset(spark: SparkSession, fmt: str, data_files: str | list[str] | None, split: str = "train", **options: str) -> DataFrame:
    """Local json, csv or parquet files of one split."""
    if fmt not in ("json", "csv", "parquet", "orc"):
        raise ValueError(f"unknown format {fmt}")
    files = parse_data_files(data_files)
    if isinstance(files, dict):
        if split not in files:
            raise ValueError(f"no split {split}; there are {', '.join(sorted(files))}")
        files = files[split]
    if not files:
        raise ValueError("no data files")
    return spark.read.format(fmt).options(**options).load(files)


def nested(df: DataFrame, name: str) -> Column:
    """A column by dotted name: a literal top-level name wins, then the path; null if there is neither."""
    if name in df.columns:
        return F.col(f"`{name}`")
    kind, parts = df.schema, name.split(".")
    for part in parts:
        if not isinstance(kind, StructType) or part not in kind.names:
            return F.lit(None)
        kind = kind[part].dataType
    return F.col(".".join(f"`{p}`" for p in parts))


def coerce_text(df: DataFrame, name: str) -> Column:
    """Text of any column: null is empty, lists are joined by spaces."""
    column = nested(df, name)
    kind = df.select(column.alias("x")).schema["x"].dataType.simpleString()
    text = F.array_join(column.cast("array<string>"), " ") if kind.startswith("array") else column.cast("string")
    return F.coalesce(text, F.lit(""))


def manifest_index(manifest: DataFrame, caption: str = "caption") -> DataFrame:
    """The columns that sampling needs: speaker_id, category, has_caption, num_frames (-1 if unknown). Rows need text and latent_path."""
    ready = manifest.where("coalesce(trim(text), '') <> '' and coalesce(trim(latent_path), '') <> ''")
    has = F.lit(False)
    if caption in manifest.columns:
        column = F.col(caption)
        listed = manifest.schema[caption].dataType.simpleString().startswith("array")
        has = F.coalesce(F.exists(column, lambda c: F.trim(c) != "") if listed else F.trim(column) != "", F.lit(False))
    frames = F.expr("try_cast(num_frames as int)") if "num_frames" in manifest.columns else F.lit(None).cast("int")
    optional = lambda c: F.col(c) if c in manifest.columns else F.lit(None).cast("string")
    return ready.select(
        *[c for c in ("id",) if c in manifest.columns], optional("speaker_id").alias("speaker_id"), optional("category").alias("category"), has.alias("has_caption"),
        F.when(F.coalesce(frames, F.lit(-1)) < 0, -1).otherwise(frames).alias("num_frames"),
    )


def cached_documents(documents: DataFrame, schema_version: int | str, model: str) -> DataFrame:
    """Cache entries that may be used again: this schema and model, and no error. documents: id, fingerprint, schema_version, model, status, result."""
    return documents.where((F.col("schema_version") == schema_version) & (F.col("model") == model) & (F.col("status") != "error"))


#: Version of saved indexes.
INDEX_VERSION = 1


def saved_index(spark: SparkSession, path: str, schema: StructType | str, cache: str, caption: str = "caption") -> DataFrame:
    """The index of a manifest, from the cache if that is of this version, file (size and time) and caption column, and whole; else made and saved."""
    from loomspark.plans.runner import file_stamp

    stamp = json.dumps({"version": INDEX_VERSION, "caption": caption, **{k: v for k, v in file_stamp(spark, path).items() if k != "path"}}, sort_keys=True)
    try:
        known = spark.read.json(f"{cache}/about").first()
        index = spark.read.parquet(f"{cache}/rows")
        if known["stamp"] == stamp and index.count() == known["rows"]:
            return index
    except AnalysisException:  # there is no cache, or none that can be read
        pass
    manifest_index(read_manifest(spark, path, schema), caption).write.mode("overwrite").parquet(f"{cache}/rows")
    index = spark.read.parquet(f"{cache}/rows")
    spark.createDataFrame([(stamp, index.count())], "stamp string, rows long").coalesce(1).write.mode("overwrite").json(f"{cache}/about")
    return index


def rows_at(manifest: DataFrame, places: DataFrame, key: str = "idx") -> DataFrame:
    """Rows at the asked places, once for each time they are asked for; a place that isn't there is left out."""
    return places.select(key).join(manifest, key)


def skipped_first(rows: DataFrame, count: int, order: str = "idx", native_shards: bool = False, world: int = 1) -> DataFrame:
    """rows from place `count` on. Refused where a reader of several shards of its own would skip in each of them."""
    if count < 0:
        raise ValueError("the number of rows to skip can't be negative")
    if count and native_shards and world > 1:
        raise ValueError("rows can't be skipped with native sharding over several readers")
    return rows.where(F.col(order) >= count) if count else rows
