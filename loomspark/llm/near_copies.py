"""Groups of near copies: SimHash tables find candidates, the Jaccard similarity of the complete sets decides.

Texts with equal sets of word shingles are one node. At a similarity of 0.8 the SimHash bits of two sets differ with a chance
of 0.152 at most (0.188 for sets of four and five shingles), so 64 bits can't tell near copies from others: a node has a
fingerprint of 2,304 bits instead. 192 of them are its check, 1,152 are 96 segments of 12 bits, and each segment has a
table (multi-index hashing). Two nodes meet if they agree in a segment, which pairs of similarity 0.8 miss in all tables with
a chance of 6e-7; sets of up to seven shingles have as many segments again. Nodes that meet are compared by their checks: of
pairs of similarity 0.8, over 62 bits differ with a chance below 1e-8 (2e-6 for four and five shingles), of unlike ones 62 or fewer with one of 7e-7.

In a bucket the most copied node that is still alone meets all others (an original is copied more often than its variants),
and those that are alone and in whose checks at most 38 bits differ go with it; then the next one that is alone does. These pairs are verified on
the complete sets. Nodes with other pairs that pass are open: those of different components by then are compared in a second
round, all of them, by whole fingerprints too (over 435 bits differ with a chance of 4e-7), and verified. A group of near
copies costs few comparisons so; many unlike members of one bucket still cost a test of checks for each pair. None is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_BYTES, arrow_map, drop, mark, materialize, release, sent_if_small
from .components import connected_components
from .simhash import kept, spread_out, stamp_of

BITS = 64
#: Fixed values of near-duplicate stages on word shingles.
WORDS = 5
LEAST = (4, 5)  # similarity as a fraction: 0.8
#: Segments of a fingerprint, each with a table, and their bits. Sets of up to SMALL shingles have twice as many.
SEGMENTS, WIDTH, SMALL = 96, 12, 7
#: Longs of a fingerprint that are its check, bits in which the checks of near copies may differ, and of those compared at once.
CHECK, MAY_DIFFER, AT_ONCE = 3, 62, 38
#: Longs of a fingerprint: all (check, segments, others; small sets have more), and the segments. Bits of all in which near copies may differ.
LONGS, SEGMENT_LONGS, ALL_DIFFER = 36, SEGMENTS * WIDTH // BITS, 435
#: Nodes that a group of buckets should hold; more nodes, more groups.
GROUP_NODES = 1 << 17
#: Largest number of shingles that is broadcast; more are joined by shuffles.
BROADCAST_SHINGLES = 4_000_000


def shingled(df: DataFrame, id_col: str, text_col: str, words: int, what: str) -> DataFrame:
    """stamp, node long (a digest of the set of shingles), size int, and what: bits (the fingerprint, no longs without words) or shingles (the set).

    A-Z is lower-cased, words are runs without ASCII white space. A text with fewer words has one shingle, its whole
    sequence; texts without words have node 0. Shingles are XXH64 values (seed 42). Each value is mixed into as many
    longs as a fingerprint has, and a bit of the fingerprint is set if it is set in over half of the set's.
    """
    longs = T.ArrayType(T.LongType())
    fields = [T.StructField(id_col, df.schema[id_col].dataType), T.StructField("stamp", T.LongType()), T.StructField("node", T.LongType(), False), T.StructField("size", T.IntegerType(), False)]
    schema = T.StructType([*fields, T.StructField(what, longs, False)])
    lower = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        rng = np.random.default_rng(8)
        most = CHECK + 2 * SEGMENT_LONGS
        odd = rng.integers(0, 1 << 63, (most, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        shift = rng.integers(0, 1 << 63, (most, 1), dtype=np.uint64) * np.uint64(2)
        again, lanes = np.uint64(0x9FB21C651E98DF25), np.uint64(0x0101010101010101)
        half, third = np.uint64(32), np.uint64(29)
        chunk = 255  # shingles at a time: what a byte can count

        def shingles(text: str | None) -> np.ndarray:
            parts = (text or "").encode().translate(lower).split()
            if not parts:
                return np.zeros(0, dtype=np.uint64)
            joined = b" ".join(parts)
            ends = np.cumsum([len(p) + 1 for p in parts])
            starts = [0, *ends[:-1].tolist()]
            stops = (ends - 1).tolist()
            stops = stops[words - 1 :] if len(parts) >= words else stops[-1:]
            return np.unique(np.array([xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, stops)], dtype=np.uint64))

        def bits(h: np.ndarray) -> np.ndarray:
            longs = most if len(h) <= SMALL else LONGS
            counts = np.zeros((8, longs, 8), dtype=np.int64)  # bit of a byte, long, byte of a long
            for at in range(0, len(h), chunk):
                x = h[at : at + chunk] * odd[:longs] + shift[:longs]
                x ^= x >> half
                x *= again
                x ^= x >> third
                for i in range(8):
                    counts[i] += (x >> np.uint64(i) & lanes).sum(axis=1).view(np.uint8).reshape(longs, 8)
            is_set = (counts * 2 > len(h)).transpose(1, 2, 0).reshape(-1)
            return np.packbits(is_set, bitorder="little").view(np.uint64)

        made = {"bits": bits, "shingles": lambda h: h}[what]
        for batch in batches:
            nodes, sizes, lists = [], [], []
            for text in batch.column(2):
                h = shingles(text.as_py())
                nodes.append(xxh64_intdigest(h.tobytes(), 7) if len(h) else 0)
                sizes.append(len(h))
                lists.append(made(h) if len(h) else h)
            ends = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
            flat = np.concatenate(lists) if lists else np.zeros(0, dtype=np.uint64)
            columns = [batch.column(0), batch.column(1), pa.array(np.array(nodes, dtype=np.uint64).view(np.int64)), pa.array(sizes, pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))], names=schema.names)

    return arrow_map(df.select(id_col, stamp_of(F.col(text_col)).alias("stamp"), text_col), run, schema)


def _entry(rooted: bool) -> list:
    """Fields of a node in a bucket."""
    return [("key", "<u2"), ("copies", "<u2"), ("size", "<i4"), ("node", "<i8"), ("check", "<u8", CHECK), *([("root", "<i8")] if rooted else [])]


def dealt(nodes: DataFrame, prefix: int, rooted: bool) -> DataFrame:
    """Entries of nodes (node, size, copies, bits, and root if rooted) in the tables of all segments.

    One row for each batch of nodes and group of buckets (a table's keys with the same first bits, as many as prefix): group int, entries binary.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        places = 1 << np.arange(WIDTH, dtype=np.uint16)
        for batch in batches:
            column = {n: batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(batch.schema.names) if n != "bits"}
            lists = batch.column(batch.schema.names.index("bits"))
            lengths, flat = lists.value_lengths().to_numpy(zero_copy_only=False), lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            begins = np.cumsum(lengths) - lengths
            groups, packed = [], []
            for tables in (SEGMENTS, 2 * SEGMENTS):
                longs = CHECK + tables * WIDTH // BITS
                rows = np.flatnonzero(lengths == (LONGS if tables == SEGMENTS else longs))
                if not len(rows):
                    continue
                prints = flat[begins[rows][:, None] + np.arange(longs)]
                bits = np.unpackbits(np.ascontiguousarray(prints[:, CHECK:]).view(np.uint8), axis=1, bitorder="little")
                keys = (bits.reshape(len(rows), tables, WIDTH) * places).sum(axis=2, dtype=np.uint16)
                entries = np.zeros(len(rows), dtype=_entry(rooted))
                entries["copies"] = np.minimum(column["copies"][rows], 0xFFFF)
                entries["check"] = prints[:, :CHECK]
                for name in ("size", "node", *(["root"] if rooted else [])):
                    entries[name] = column[name][rows]
                for at in range(tables):
                    entries["key"] = keys[:, at]
                    first = keys[:, at] >> (WIDTH - prefix)
                    order = np.argsort(first, kind="stable")
                    cuts = np.flatnonzero(np.diff(first[order])) + 1
                    for part in np.split(order, cuts):
                        groups.append(at << prefix | int(first[part[0]]))
                        packed.append(entries[part].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(groups, pa.int32()), pa.array(packed, pa.binary())], names=["group", "entries"])

    columns = ["node", "size", "copies", "bits", *(["root"] if rooted else [])]
    schema = T.StructType([T.StructField("group", T.IntegerType(), False), T.StructField("entries", T.BinaryType(), False)])
    return arrow_map(spread_out(nodes.select(*columns), "node"), run, schema)


def met(groups: DataFrame, rooted: bool, parts: int, prints: Broadcast | None = None) -> DataFrame:
    """Distinct pairs (a, b) of nodes that share a bucket and pass the test of their checks and sizes.

    Not rooted: a < b of nodes that are alone when their turn comes with others of the bucket, and (a, a) for nodes with pairs left.
    Rooted: a < b of different roots; prints (nodes in order, their fingerprints and their sizes) test them by whole fingerprints, too.
    """

    def run(table):  # one group's rows
        import numpy as np
        import pyarrow as pa

        raw = b"".join(e.as_py() for e in table.column("entries"))
        e = np.frombuffer(raw, dtype=_entry(rooted))
        by = (e["node"], e["root"], e["key"]) if rooted else (e["node"], -e["copies"].astype(np.int32), e["key"])
        e = e[np.lexsort(by)]

        def runs(*columns) -> tuple:
            """Where runs of equal values begin, and their lengths."""
            new = np.ones(len(columns[0]), dtype=bool)
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
            begins = np.flatnonzero(new)
            return begins, np.diff(np.append(begins, len(new)))

        _, lengths = runs(e["key"])
        e = e[np.repeat(lengths > 1, lengths)]
        if rooted and len(e):  # buckets of several roots
            begins, lengths = runs(e["key"])
            mixed = e["root"][begins] != e["root"][begins + lengths - 1]
            e = e[np.repeat(mixed, lengths)]
        pairs = []
        if len(e):
            begins, lengths = runs(e["key"])
            node, size, checks = e["node"].copy(), e["size"].astype(np.int64), [e["check"][:, i].copy() for i in range(CHECK)]
            waiting = np.ones(len(e), dtype=bool)  # their turn to meet the others may come
            untested = np.ones(len(e), dtype=bool)  # haven't met all others yet
            if rooted:  # the members of a bucket's commonest root need no turn
                at, n = runs(e["key"], e["root"])
                bucket = np.repeat(np.arange(len(begins)), lengths)[at]
                common = at[np.lexsort((-n, bucket))][np.append(True, np.diff(np.sort(bucket)) > 0)]
                counts = n[np.searchsorted(at, common)]
                waiting[np.repeat(common, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)] = False
            p, q = LEAST
            while True:
                offsets = np.cumsum(lengths) - lengths
                idx = np.repeat(begins - offsets, lengths) + np.arange(lengths.sum())
                turn = np.minimum.reduceat(np.where(waiting[idx], idx, len(e)), offsets)
                live = turn < len(e)
                if not live.any():
                    break
                if not live.all():
                    idx, begins, lengths, turn = idx[np.repeat(live, lengths)], begins[live], lengths[live], turn[live]
                waiting[turn] = untested[turn] = False
                one = np.repeat(turn, lengths)
                differ = sum(np.bitwise_count(c[idx] ^ np.repeat(c[turn], lengths)).astype(np.uint8) for c in checks)
                hits = np.flatnonzero((differ <= MAY_DIFFER) & untested[idx])
                one, other = one[hits], idx[hits]
                near = (p * size[one] <= q * size[other]) & (p * size[other] <= q * size[one]) & (node[one] != node[other])
                if rooted:
                    near &= e["root"][one] != e["root"][other]
                one, other = one[near], other[near]
                if not rooted:
                    left = (differ[hits[near]] > AT_ONCE) | ~waiting[other]
                    pairs += [np.stack([node[x], node[x]]) for x in (one[left], other[left], one[~left], other[~left])]
                    one, other = one[~left], other[~left]
                    waiting[other] = False
                elif prints is not None:
                    near = whole(node[one], node[other])
                    one, other = one[near], other[near]
                pairs.append(np.stack([np.minimum(node[one], node[other]), np.maximum(node[one], node[other])]))
        a, b = once(np.concatenate(pairs, axis=1)) if pairs else np.zeros((2, 0), dtype=np.int64)
        part = (a.view(np.uint64) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        cuts = np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if len(order) else []
        packed = [np.stack([a[c], b[c]]).tobytes() for c in cuts]
        return pa.table({"part": pa.array([int(part[c[0]]) for c in cuts], pa.int32()), "pairs": pa.array(packed, pa.binary())})

    def union(table):  # pairs of many groups, each once
        import numpy as np
        import pyarrow as pa

        a, b = once(np.concatenate([np.frombuffer(x.as_py(), dtype=np.int64).reshape(2, -1) for x in table.column("pairs")], axis=1))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    def once(pairs):
        import numpy as np

        pairs = pairs[:, np.lexsort(pairs)]
        new = np.ones(pairs.shape[1], dtype=bool)
        new[1:] = (pairs[:, 1:] != pairs[:, :-1]).any(axis=0)
        return pairs[:, new]

    def whole(x, y):
        import numpy as np

        nodes, bits, sizes = prints.value
        x, y = np.searchsorted(nodes, x), np.searchsorted(nodes, y)
        differ = np.zeros(len(x), dtype=np.int64)
        for at in range(0, len(x), 1 << 12):
            here = slice(at, at + (1 << 12))
            differ[here] = np.bitwise_count(bits[x[here]] ^ bits[y[here]]).sum(axis=1, dtype=np.int64)
        return (differ <= ALL_DIFFER) | (np.minimum(sizes[x], sizes[y]) <= SMALL)

    packed = groups.groupBy("group").applyInArrow(run, "part int, pairs binary")
    return packed.groupBy("part").applyInArrow(union, "a long, b long")


def _sent_prints(nodes: DataFrame) -> Broadcast | None:
    """Fingerprints of nodes for :func:`met`, unless they are too many; the test is only to spare verifications."""
    import numpy as np

    if nodes.count() * (LONGS + 2) * 8 > BROADCAST_BYTES:
        return None
    got = nodes.where("size > 0").select("node", "size", F.slice("bits", 1, LONGS).alias("bits")).toPandas().sort_values("node")
    bits = np.stack(got["bits"].to_numpy()).view(np.uint64) if len(got) else np.zeros((0, LONGS), dtype=np.uint64)
    return nodes.sparkSession.sparkContext.broadcast((got["node"].to_numpy(), bits, got["size"].to_numpy()))


def _verified(pairs: DataFrame, nodes: DataFrame, df: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """The pairs (a, b) whose complete sets are similar enough. Only texts of their nodes are read again."""
    used = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    used = materialize(nodes.join(used, "node", "left_semi").select(F.col("first_id").alias(id_col), "size"), "near-used")
    small = (used.agg(F.sum(F.col("size").cast("long"))).first()[0] or 0) <= BROADCAST_SHINGLES
    sets = materialize(shingled(df.join(sent_if_small(used.select(id_col), 48), id_col, "left_semi"), id_col, text_col, words, "shingles").select("node", "shingles"), "near-sets")
    sent = F.broadcast if small else lambda side: side
    left = sent(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")))
    right = sent(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")))
    p, q = LEAST
    near = (p + q) * F.size(F.array_intersect("x", "y")) >= p * (F.size("x") + F.size("y"))  # both / (x + y - both) >= p / q
    found = materialize(pairs.join(left, "a").join(right, "b").where(near).select("a", "b").distinct(), "near-links")
    drop(used)
    drop(sets)
    return found


def near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """Component of each document that has an id.

    Documents link if the Jaccard similarity of their sets of shingles is 0.8 or more; a component is named by its
    smallest id. Texts without words, null ones too, link to each other. Returns id_col, stamp (a hash of the text),
    component_id, root (the component's own name); repeated rows get equal results, and an empty table gives an empty one.
    """
    before = mark()
    prints = materialize(shingled(df.where(F.col(id_col).isNotNull()), id_col, text_col, words, "bits"), "near-prints")
    nodes = prints.groupBy("node", "size", "bits").agg(F.min(id_col).alias("first_id"), F.count("*").alias("copies"))
    nodes = materialize(nodes, "near-nodes")
    prefix = min(WIDTH, max(0, (nodes.count() - 1) // GROUP_NODES).bit_length())
    parts = 16 << prefix
    passed = materialize(met(dealt(nodes, prefix, rooted=False), False, parts), "near-passed")
    first = materialize(passed.where("a < b"), "near-first")
    links = _verified(first, nodes, df, id_col, text_col, words)

    roots = connected_components(links).withColumnRenamed("node", "n")
    used = passed.where("a = b").select(F.col("a").alias("node"))
    open_ = nodes.join(used, "node", "left_semi").join(roots, F.col("node") == F.col("n"), "left").withColumn("root", F.coalesce("root", "node"))
    open_ = materialize(open_.drop("n"), "near-open")
    prints_sent = _sent_prints(open_)
    rest = met(dealt(open_, prefix, rooted=True), True, parts, prints_sent)
    rest = materialize(rest.join(first, ["a", "b"], "left_anti"), "near-rest")
    if prints_sent is not None:
        prints_sent.unpersist()
    links = links.unionByName(_verified(rest, nodes, df, id_col, text_col, words))

    roots = materialize(connected_components(links).withColumnRenamed("node", "n"), "near-roots")
    named = nodes.select("node", "first_id").join(roots, F.col("node") == F.col("n"), "left").select("node", "first_id", F.coalesce("root", "node").alias("root"))
    named = materialize(named, "near-named")
    least = materialize(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "near-least")
    table = materialize(named.join(least, "root").select("node", "component_id", "root"), "near-table")
    release(before, prints, table)
    return prints.join(table, "node").select(id_col, "stamp", "component_id", "root")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """df with one document of each component of :func:`near_copies`; null and repeated ids as :func:`simhash.kept`."""
    return kept(df, near_copies(df, id_col, text_col, words), id_col, text_col)
