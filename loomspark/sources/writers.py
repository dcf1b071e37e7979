"""Sinks: manifests as JSON lines, status-routed outputs, skip sidecars, versioned publishing."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def write_manifest(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines; null keys are left out, so that an absent key stays absent."""
    df.write.mode(mode).option("ignoreNullFields", "true").json(path)


def append_log(df: DataFrame, path: str) -> None:
    """Appends rows to a log that is read with the last write of a key winning."""
    df.write.mode("append").option("ignoreNullFields", "true").json(path)


def write_routed(df: DataFrame, path: str, status: str = "status") -> None:
    """One folder for each status, in one pass over the rows."""
    df.write.mode("overwrite").partitionBy(status).parquet(path)


def skip_sidecar(df: DataFrame, reason: str = "skip_reason") -> tuple[DataFrame, DataFrame]:
    """(kept rows, skipped rows as idx, reason and error)."""
    error = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    return df.where(F.col(reason).isNull()).drop(reason), df.where(F.col(reason).isNotNull()).select("idx", F.col(reason).alias("reason"), error.alias("error"))


def append_metrics(df: DataFrame, path: str, step: str = "step") -> None:
    """Appends every numeric column of a metric table as rows (step, metric, value), for any sink that reads tables."""
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name != step]
    long = df.select(F.col(step).cast("long").alias("step"), *[F.col(c).cast("double").alias(c) for c in numbers]).unpivot("step", numbers, "metric", "value")
    long.where("value is not null").write.mode("append").parquet(path)


def concat_shards(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rank shards one after the other, with the shard's number; a missing shard is passed over."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    there = [(i, p) for i, p in enumerate(paths) if (h := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(h)]
    if not there:
        raise ValueError("no shard is there")
    out = None
    for i, p in there:
        part = spark.read.json(p).withColumn("shard", F.lit(i))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def publish(df: DataFrame, root: str, expected_rows: int | None = None, keep: int = 5) -> dict:
    """Writes a new version below root, checks its row count, points CURRENT at it, and keeps the newest versions.

    A reader that follows CURRENT sees the old or the new version, never a part. Returns the receipt.
    """
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(conf)
    stamp = datetime.now(timezone.utc).strftime("v%Y%m%dT%H%M%S%f")
    df.write.parquet(f"{root}/{stamp}")
    rows = spark.read.parquet(f"{root}/{stamp}").count()
    if expected_rows is not None and rows != expected_rows:
        files.delete(path(f"{root}/{stamp}"), True)
        raise ValueError(f"{rows} rows instead of {expected_rows}: not published")
    previous = current(spark, root)
    out = files.create(path(f"{root}/CURRENT.next"), True)
    out.write(bytearray(stamp.encode()))
    out.close()
    # Renamed over the old one in one step, so that there is always one.
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(root).toUri() if path(root).toUri().getScheme() else files.getUri(), conf).rename(
        files.makeQualified(path(f"{root}/CURRENT.next")), files.makeQualified(path(f"{root}/CURRENT")), over
    )
    versions = sorted(s.getPath().getName() for s in files.listStatus(path(root)) if s.isDirectory())
    for old in versions[:-keep]:
        files.delete(path(f"{root}/{old}"), True)
    return {"version": stamp, "rows": rows, "previous": previous, "completed_at": stamp[1:]}


def current(spark: SparkSession, root: str) -> str | None:
    """Name of the published version, if any."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(f"{root}/CURRENT")
    if not place.getFileSystem(conf).exists(place):
        return None
    return spark.read.text(f"{root}/CURRENT").first()[0]
