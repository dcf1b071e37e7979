"""Removal of lines that spread over many sites.

A line's spread is the number of distinct sites that carry it. HyperLogLog sketches of sites, one for each
line hash, merge by aggregation; lines whose estimate is near the threshold get an exact distinct count.
A line that spreads stays once, in the document with the smallest id, and goes from all others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, mark, materialize, read_gently, release, sent_if_small

BLANKS = " \t\r"


def line_keys(df: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """One row (k1, k2, site, id) for each non-blank line: 128 bits of hash of the line without blanks around it."""
    lines = df.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(site_col).cast("string"), F.lit("")).alias("site"),
        F.explode(F.array_distinct(F.split(F.col(text_col), "\n"))).alias("line"),
    ).withColumn("line", F.btrim("line", F.lit(BLANKS)))
    return lines.where("line <> ''").select(F.xxhash64("line").alias("k1"), F.xxhash64("line", F.lit(1)).alias("k2"), "site", "id")


def spread_lines(keys: DataFrame, min_sites: int, margin: float = 0.25, lg_k: int = 12, salts: int = 256) -> DataFrame:
    """Keys (k1, k2, owner) of lines on at least min_sites sites; owner: the smallest id that has the line.

    A line on fewer than min_sites rows, or on one site only, can't spread and gets no sketch. The others
    are dealt out by key and salt, so that a very common line's sketch is built by several tasks. The
    sketch's error at 2**12 registers is 1.6 %; estimates within margin of min_sites are counted exactly.
    """
    rows = keys.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min(F.xxhash64("site")).alias("s0"), F.max(F.xxhash64("site")).alias("s1"), F.min("id").alias("owner"))
    likely = materialize(rows.where((F.col("n") >= min_sites) & ((F.col("s0") != F.col("s1")) | F.lit(min_sites <= 1))).select("k1", "k2", "owner"), "line-likely")
    carried = keys.join(likely.select("k1", "k2"), ["k1", "k2"], "left_semi").select("k1", "k2", "site", "id")
    carried = materialize(carried, "line-carried")
    salted = carried.repartition("k1", "k2", F.pmod(F.xxhash64("id", "site"), F.lit(salts)))
    part = salted.groupBy("k1", "k2", F.pmod(F.xxhash64("id", "site"), F.lit(salts)).alias("salt")).agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"))
    spread = part.groupBy("k1", "k2").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("sites"))
    spread = materialize(spread, "line-spread")
    low, high = min_sites * (1 - margin), min_sites * (1 + margin)
    near = spread.where(F.col("sites").between(low, high)).select("k1", "k2")
    exact = carried.join(near, ["k1", "k2"], "left_semi").select("k1", "k2", "site").distinct().groupBy("k1", "k2").count()
    over = spread.where(F.col("sites") > high).select("k1", "k2").unionByName(exact.where(F.col("count") >= min_sites).select("k1", "k2"))
    return likely.join(over, ["k1", "k2"]).select("k1", "k2", "owner")


def drop_spread_lines(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = 5,
) -> DataFrame:
    """df with its text freed of lines that other documents own, and a column removed_lines (int).

    A line spreads if at least min_sites distinct sites carry it (a null site is a site of its own). It
    stays in the documents with the smallest id that has it, there at its first place; all other
    occurrences go. Lines are compared without blanks around them; blank lines stay. A text may become
    empty; null stays null with 0 removed. Rows without an id own a line only if no row with an id has it;
    all of them keep it then, at its first place. All rows and columns of df stay (a column removed_lines of
    df is replaced); repeated rows get equal results. An empty table gives an empty result.

    Places to drop are found by a join on the line's hash and grouped by row (id and hash of the text); the
    texts that have some are cut there. All of it are DataFrame expressions; a text's places are no more than its lines.
    Texts are shuffled only if the table of places, by its counted size, is too large to broadcast.
    """
    read_gently(df.sparkSession)
    df, before = df.drop("removed_lines"), mark()
    keys = materialize(line_keys(df, id_col, text_col, site_col), "line-keys")
    found = materialize(spread_lines(keys, min_sites), "line-boilerplate")
    text = F.col(text_col)
    stamps = [F.xxhash64(text), F.xxhash64(text, F.lit(1))]
    lines = df.select(F.col(id_col).alias("id"), *[s.alias(f"s{i}") for i, s in enumerate(stamps)], F.posexplode(F.split(text, "\n")).alias("at", "line"))
    lines = lines.withColumn("line", F.btrim("line", F.lit(BLANKS))).where("line <> ''")
    lines = lines.select("id", "s0", "s1", "at", F.xxhash64("line").alias("k1"), F.xxhash64("line", F.lit(1)).alias("k2"))
    held = materialize(lines.join(found, ["k1", "k2"]).select("id", "s0", "s1", "at", "k1", "k2", F.col("owner").eqNullSafe(F.col("id")).alias("own")), "line-held", merged=True)
    # The first place of a line that the row owns stays.
    least = held.groupBy("id", "s0", "s1", "k1", "k2", "own").agg(F.sort_array(F.collect_set("at")).alias("at"))
    gone = least.select("id", "s0", "s1", F.when(F.col("own"), F.slice("at", 2, F.size("at"))).otherwise(F.col("at")).alias("at"))
    own = [fresh(df, c) for c in ("__id", "__s0", "__s1", "__gone")]
    drops = gone.groupBy("id", "s0", "s1").agg(F.flatten(F.collect_list("at")).alias("at")).where(F.size("at") > 0).toDF(*own)
    drops = materialize(drops, "line-drops")
    release(before, drops)
    same = F.col(id_col).eqNullSafe(F.col(own[0])) & (stamps[0] == F.col(own[1])) & (stamps[1] == F.col(own[2]))
    places = F.col(own[3])
    out = df.join(sent_if_small(drops, 64 + 4 * F.size(places)), same, "left")
    # Lines and kept places are each computed once, as arguments of the outer functions.
    cut = F.transform(
        F.array(F.split(text, "\n")),
        lambda parts: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), places), lambda at: F.get(parts, at)), "\n"),
    )[0]
    text = F.when(places.isNull(), text).otherwise(cut)
    count = F.when(places.isNull(), 0).otherwise(F.size(places)).cast("int")
    return out.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns], count.alias("removed_lines"))
