"""SimHash fingerprints and their groups under a Hamming distance of 2, by multi-index hashing.

A fingerprint has two segments of 32 bits. Of two fingerprints that differ in at most 2 bits, one segment differs
in at most 1. So every fingerprint is stored in a table for each segment under the segment's value, and looks up the
ball of radius 1 around its own values there; the complete distance of what it meets is verified. A pair that
differs in one bit of a segment is met from the side that has the bit set, so only clearing flips are looked up.

A crowded bucket (many fingerprints that share a segment's ball) isn't paired: its members are indexed again by the
other segment, where at most 65 fingerprints can share a key; all of these are within 2 bits and link to the smallest.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import connected_components
from .common import arrow_map, drop, fresh, mark, materialize, release, sent_if_small

BITS, SEGMENTS, WIDTH = 64, 2, 32
#: Bits in which linked fingerprints differ at most; a segment's ball has half of it as radius.
LINK_DISTANCE = 2
#: Members of a bucket whose pairs are compared; a bucket with more is indexed again.
CROWD = 16


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """64-bit SimHash of each whole text over shingles of so many words.

    A-Z is lower-cased, words are runs without ASCII white space, shingles are joined by one space and
    count as often as they occur. A text with fewer words has one shingle, its whole sequence; one without
    words (null and empty texts too) has fingerprint 0. A bit is set if it is set in over half of the
    shingles' XXH64 values (seed 42).

    Returns id_col, stamp long (a hash of the text, of its own for null), fp long (the bits, signed); one row for each
    input row. No shuffle.
    """
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("stamp", T.LongType()), T.StructField("fp", T.LongType(), False)])
    lower = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        weights = 1 << np.arange(BITS, dtype=np.uint64)
        chunk = 1 << 16  # shingles at a time, so that long texts stay small in memory

        def one(text: str | None) -> int:
            parts = (text or "").encode().translate(lower).split()
            if not parts:
                return 0
            joined = b" ".join(parts)
            ends = np.cumsum([len(p) + 1 for p in parts])
            starts = np.concatenate(([0], ends[:-1])).tolist()
            stops = (ends - 1).tolist()
            n = max(1, len(parts) - words + 1)
            stops = stops[words - 1 :] if len(parts) >= words else stops[-1:]
            counts = np.zeros(BITS, dtype=np.int64)
            for at in range(0, n, chunk):
                h = np.array([xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts[at : min(n, at + chunk)], stops[at : at + chunk])], dtype="<u8")
                bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                counts += bits.sum(axis=0, dtype=np.int64)
            return int(weights[counts * 2 > n].sum(dtype=np.uint64))

        for batch in batches:
            found = np.array([one(t.as_py()) for t in batch.column(2)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], names=schema.names)

    return arrow_map(df.select(id_col, stamp_of(F.col(text_col)).alias("stamp"), text_col), run, schema)


def stamp_of(text: Column) -> Column:
    """A hash that tells texts of one id apart."""
    return F.xxhash64(text, text.isNull())


def segment(fp: Column, at: int) -> Column:
    """The value of a segment, from 0 to 2**32 - 1."""
    return F.shiftrightunsigned(fp, WIDTH * at).bitwiseAND(F.lit((1 << WIDTH) - 1))


def table_key(at: int, value: Column) -> Column:
    """Key of a segment's value in the tables of all segments."""
    return value + F.lit(at << WIDTH)


def lookups(fp: Column) -> Column:
    """Keys that a fingerprint is stored under (own) and looks up: each segment's value, and the value with one set bit cleared."""
    rows = []
    for at in range(SEGMENTS):
        value = segment(fp, at)
        rows.append(F.struct(table_key(at, value).alias("key"), F.lit(True).alias("own")))
        for bit in range(WIDTH):
            is_set = value.bitwiseAND(F.lit(1 << bit)) != 0
            rows.append(F.struct(F.when(is_set, table_key(at, value - F.lit(1 << bit))).alias("key"), F.lit(False).alias("own")))
    return F.array(*rows)


def link_fingerprints(distinct: DataFrame) -> DataFrame:
    """Links (a, b), a < b, whose components are those of all pairs at a distance of 2 or less.

    distinct: column fp, without repetition. A bucket of up to CROWD members gives its verified pairs; a larger one is
    indexed again, so no bucket of any size is paired or gathered as a whole. No link is lost.
    """
    near = lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= LINK_DISTANCE
    keyed = spread_out(distinct, "fp").select("fp", F.explode(lookups(F.col("fp"))).alias("k")).select("fp", "k.key", "k.own").where("key is not null")
    buckets = keyed.groupBy("key").agg(F.count("*").alias("n"), F.count_if("own").alias("stored")).where("stored > 0 and n > 1")
    buckets = materialize(buckets.select("key", "n"), "simhash-buckets")
    members = materialize(keyed.join(buckets, "key"), "simhash-members", merged=True)
    drop(buckets)

    few = members.where(F.col("n") <= CROWD).groupBy("key").agg(F.collect_list("fp").alias("members"))
    partners = lambda a: F.transform(F.filter("members", lambda b: (a < b) & near(a, b)), lambda b: F.struct(a.alias("a"), b.alias("b")))
    pairs = few.select(F.explode(F.flatten(F.transform("members", partners))).alias("p")).select("p.a", "p.b")

    # Those stored under a key share the segment: what they differ in lies in the other one, at most one bit from the
    # middle. Those that look the key up differ in one bit already, so the other segment is theirs or one bit from it.
    other = F.when(F.col("key") < F.lit(1 << WIDTH), segment(F.col("fp"), 1)).otherwise(segment(F.col("fp"), 0))
    ball = F.array(other, *[other.bitwiseXOR(F.lit(1 << bit)) for bit in range(WIDTH)])
    again = members.where(F.col("n") > CROWD).select("key", "fp", F.explode(F.when(F.col("own"), ball).otherwise(F.array(other))).alias("inner"))
    inner = again.groupBy("key", "inner").agg(F.count("*").alias("n"), F.min("fp").alias("a")).where("n > 1").select("key", "inner", "a")
    stars = again.join(materialize(inner, "simhash-inner"), ["key", "inner"]).select("a", F.col("fp").alias("b"))
    return pairs.unionByName(stars.where((F.col("a") < F.col("b")) & near(F.col("a"), F.col("b")))).distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """Fingerprint and component of each document.

    Documents link if their fingerprints differ in 2 bits or fewer; a component is named by its
    smallest id (null if none of its rows has one). Returns id_col, stamp long (a hash of the text), fp long,
    component_id, root (the component's own name, as rows can share ids), one row for each input row; equal rows get equal results. Null and empty texts have fingerprint 0 and
    link like any other. An empty table gives an empty result.

    Texts are read once; from there on only ids and fingerprints move. Equal fingerprints are one node, so
    a group of copies costs one row after each task's own aggregation.
    """
    before = mark()
    prints = materialize(fingerprints(df, id_col, text_col, words), "simhash-prints")
    nodes = materialize(prints.groupBy("fp").agg(F.min(id_col).alias("first_id")), "simhash-nodes")
    roots = connected_components(link_fingerprints(nodes.select("fp")))  # node, root: linked nodes only
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = materialize(named, "simhash-named")
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    table = materialize(named.join(materialize(least, "simhash-least"), "root").select("fp", "component_id", "root"), "simhash-table")
    release(before, prints, table)
    return prints.join(table, "fp").select(id_col, "stamp", "fp", "component_id", "root")


def spread_out(nodes: DataFrame, key: str) -> DataFrame:
    """The rows in as many partitions as a shuffle has, as each becomes many rows; a small table would stay in one or two."""
    return nodes.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """df with one document of each component of :func:`near_duplicates`, the one with the smallest id.

    Rows with a null id stay. Of rows that repeat both id and text one stays. Rows that share an id but not the text are
    documents of their own: only one of the component's goes on, whatever id it shares.
    """
    return kept(df, near_duplicates(df, id_col, text_col, words), id_col, text_col)


def kept(df: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """df without the documents of found (id_col, stamp, component_id, root) that don't stand for their component.

    The document with the component's smallest id does, and of several texts under that id the one with the smallest stamp.
    """
    own_id, own_stamp = fresh(df, "__lost"), fresh(df, "__stamp")
    found = found.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias(own_id), F.col("stamp").alias(own_stamp), "component_id", "root")
    first = F.col(own_id) == F.col("component_id")
    heads = found.where(first).groupBy("root").agg(F.min(own_stamp).alias("head"))
    # Only documents under a head's id can be a second text of it; all others go by their id and text alone.
    spare = found.where(first).join(heads, "root").where(F.col(own_stamp) != F.col("head"))
    lost = materialize(found.where(~first).select(own_id, own_stamp).unionByName(spare.select(own_id, own_stamp)).distinct(), "simhash-lost")
    stamp = stamp_of(F.col(text_col))
    out = df.join(sent_if_small(lost, 64), (F.col(id_col) == F.col(own_id)) & (stamp == F.col(own_stamp)), "left_anti")
    repeated = found.groupBy(own_id, own_stamp).count().where("count > 1")
    if repeated.limit(1).count():
        out = out.withColumn(own_stamp, stamp)
        once = out.where(F.col(id_col).isNotNull()).dropDuplicates([id_col, own_stamp])
        out = out.where(F.col(id_col).isNull()).unionByName(once).drop(own_stamp)
    return out
