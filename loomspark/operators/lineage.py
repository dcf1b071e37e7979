"""Merge of latent manifests from several folders: paths re-rooted, rows checked, lineage and order kept."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions.text import casefolded, strip
from loomspark.operators.manifest import work_of


def resolved_path(path: Column) -> Column:
    """An absolute path without empty, ``.`` and ``..`` parts; ``..`` at the root stays there."""
    parts = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    step = lambda kept, p: F.when(p == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(F.concat(kept, F.array(p)))
    return F.concat(F.lit("/"), F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/"))


def absolute_path(path: Column, folder: Column) -> Column:
    """A path resolved from a folder, unless it is absolute itself."""
    return resolved_path(F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat_ws("/", folder, path)))


def relative_path(path: Column, folder: Column) -> Column:
    """A resolved path as seen from a resolved folder."""
    of = lambda p: F.filter(F.split(p, "/"), lambda x: x != "")
    target, base = of(path), of(folder)
    differ = F.filter(F.sequence(F.lit(0), F.least(F.size(target), F.size(base))), lambda i: ~F.get(target, i).eqNullSafe(F.get(base, i)) | (i >= F.least(F.size(target), F.size(base))))
    common = F.get(differ, F.lit(0))
    up = F.array_repeat(F.lit(".."), F.size(base) - common)
    out = F.array_join(F.concat(up, F.slice(target, common + 1, F.greatest(F.size(target) - common, F.lit(0)))), "/")
    return F.when(out == "", ".").otherwise(out)


def parent(path: str) -> str:
    return path.rstrip("/").rpartition("/")[0] or "/"


@dataclass
class Merged:
    """Rows in their final order, and what the merge counted."""

    rows: DataFrame
    input_counts: dict[str, int]
    combined_count: int
    speaker_normalized_count: int


def refuse_copies(rows: DataFrame, key: str, what: str) -> None:
    """Raises if a non-null key occurs twice, naming the first two places. Only key and place are shuffled."""
    place = F.struct("input", "line", "location")
    copies = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"), F.min(place).alias("first"), F.max(place).alias("last")).where("n > 1")
    found = copies.orderBy("last", key).limit(1).collect()
    if found:
        r = found[0]
        raise ValueError(f"duplicate {what}: {r[key]} ({r['first']['location']} and {r['last']['location']})")


def merge_latents(parts: dict[str, DataFrame], output: str, order: str = "line", existing: DataFrame | None = None, collapse_speakers: bool = False) -> Merged:
    """Manifests, by their absolute paths, as one: each latent_path is resolved from its manifest's folder and rewritten from output's.

    Each part has latent_path, text, perhaps speaker_id and id, and its line number. Refused are: no part, an output among
    the inputs, a row without latent_path, a part without a text column, a path or non-empty id that occurs twice (both places
    are named), and, given a table of existing paths (path), a latent that isn't there. Other columns pass through.
    With collapse_speakers a speaker becomes its work code; each change of a value, or of its type to text, is counted.
    Parts whose speakers differ in type give text.

    Rows are ordered by case-folded path and speaker, then text and id.
    """
    if not parts:
        raise ValueError("no input manifest")
    if output in parts:
        raise ValueError("the output is an input too")
    tagged = []
    for place, (name, df) in enumerate(parts.items()):
        if "text" not in df.columns or "latent_path" not in df.columns:
            raise ValueError(f"text or latent_path is missing in {name}")
        where = F.concat(F.lit(f"{name}:"), F.col(order).cast("string"))
        tagged.append(df.withColumns({"input": F.lit(place), "location": where, "folder": F.lit(parent(name))}).withColumnRenamed(order, "line"))
    if len({df.schema["speaker_id"].dataType.simpleString() for df in parts.values() if "speaker_id" in df.columns}) > 1:
        own = lambda df: F.lit(df.schema["speaker_id"].dataType.simpleString() != "string")
        tagged = [df.withColumn("typed", own(df)).withColumn("speaker_id", F.col("speaker_id").cast("string")) if "speaker_id" in df.columns else df for df in tagged]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    path = strip(F.coalesce(F.col("latent_path").cast("string"), F.lit("")))
    changed = F.lit(False)
    if collapse_speakers and "speaker_id" in rows.columns:
        text = F.col("speaker_id").cast("string")
        typed = F.col("typed") if "typed" in rows.columns else F.lit(rows.schema["speaker_id"].dataType.simpleString() != "string")
        changed = F.col("speaker_id").isNotNull() & (typed | (work_of(text) != text))
        rows = rows.withColumn("speaker_changed", F.coalesce(changed, F.lit(False))).withColumn("speaker_id", F.when(F.col("speaker_id").isNotNull(), work_of(text)))
    else:
        rows = rows.withColumn("speaker_changed", changed)
    rows = rows.withColumn("absolute", F.when(path != "", absolute_path(path, F.col("folder"))))
    key = F.nullif(strip(F.coalesce(F.col("id").cast("string"), F.lit(""))), F.lit("")) if "id" in rows.columns else F.lit(None).cast("string")
    rows = rows.withColumn("own_id", key)

    counts = rows.groupBy("input").agg(F.count("*").alias("n"), F.count_if("speaker_changed").alias("changed"), F.min(F.when(F.col("absolute").isNull(), F.struct("line", "location"))).alias("bare")).collect()
    if bare := [r.bare for r in sorted(counts) if r.bare]:
        raise ValueError(f"latent_path is missing at {bare[0]['location']}")
    refuse_copies(rows, "absolute", "latent_path")
    refuse_copies(rows, "own_id", "id")
    if existing is not None:
        gone = rows.join(existing.select(F.col("path").alias("absolute")), "absolute", "left_anti").orderBy("input", "line").limit(1).collect()
        if gone:
            raise FileNotFoundError(f"latent file not found at {gone[0]['location']}: {gone[0]['absolute']}")
    out = rows.withColumn("latent_path", relative_path(F.col("absolute"), F.lit(parent(output))))
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in out.columns else F.lit("")
    out = out.orderBy(casefolded(F.col("latent_path")), casefolded(plain("speaker_id")), plain("text"), plain("id"))
    by_input = {r["input"]: r for r in counts}
    sizes = {name: by_input[i].n if i in by_input else 0 for i, name in enumerate(parts)}
    return Merged(out.drop("input", "location", "folder", "absolute", "own_id", "line", "speaker_changed", "typed"), sizes, sum(sizes.values()), sum(r.changed for r in counts))
