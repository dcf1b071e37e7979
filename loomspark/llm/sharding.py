"""Contiguous shards of least possible size over ordered atomic groups.

Rows with equal texts form a group, groups are ordered by their smallest id, and each shard takes a run of
groups. The smallest feasible capacity is found by binary search; a capacity is checked greedily, filling
one shard after the other.

The driver never sees all groups. It works on a bounded summary: sums over intervals of the group order.
Where a cut of some capacity still in question could fall into an interval, that interval is summed again
in finer parts; after a few passes every cut is known to the single group, and all other intervals are
still coarse. A shard is then a range of group ids, so rows find theirs by comparison with the cuts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, materialize

ROW_BYTES = 16
#: Intervals refined in one pass.
RANGES = 64


@dataclass
class Span:
    """Groups with ids from lo up to hi: their total, largest and number."""

    lo: int
    hi: int
    total: int
    largest: int
    groups: int


def row_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus a fixed cost."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(ROW_BYTES)).cast("long")


def text_key(text: Column) -> Column:
    """Equal for equal texts; nulls are equal to each other and to nothing else."""
    return F.coalesce(F.sha2(text, 256), F.lit("null"))


def _spans(groups: DataFrame, ranges: list[tuple[int, int]], parts: int) -> list[Span]:
    """Sums over equal parts of each id range (inclusive); at most len(ranges) * parts rows."""
    gid, kind = F.col("gid"), "decimal(20,0)"  # in decimals, so that ranges over the whole 64 bits can't overflow
    widths = [max(1, -(-(hi - lo + 1) // parts)) for lo, hi in ranges]
    index = F.when(gid.between(*ranges[0]), 0)
    for i, (lo, hi) in enumerate(ranges[1:], 1):
        index = index.when(gid.between(lo, hi), i)
    los = F.lit([str(lo) for lo, _ in ranges]).cast(f"array<{kind}>")
    sizes = F.lit([str(w) for w in widths]).cast(f"array<{kind}>")
    at = F.col("i") + 1
    part = F.floor((gid.cast(kind) - F.element_at(los, at)) / F.element_at(sizes, at)).cast("long")
    rows = (
        groups.select("gid", "size", index.alias("i"))
        .where("i is not null")
        .groupBy("i", part.alias("part"))
        .agg(F.sum("size").alias("total"), F.max("size").alias("largest"), F.count("*").alias("groups"))
        .collect()
    )
    out = []
    for r in rows:
        lo = ranges[r.i][0] + r.part * widths[r.i]
        out.append(Span(lo, min(lo + widths[r.i] - 1, ranges[r.i][1]), r.total, r.largest, r.groups))
    return sorted(out, key=lambda s: s.lo)


def greedy(spans: list[Span], capacity: int, shards: int, hopeful: bool) -> tuple[int, list[int]]:
    """Shards needed, and the indexes of the spans in which shards end.

    A span of one group is exact. In a span of several, a hopeful cut falls so that the shard is full, a
    cautious one falls before the span. Stops once more than `shards` are needed.
    """
    used, room, touched = 1, capacity, []
    for i, s in enumerate(spans):
        if s.total <= room:
            room -= s.total
            continue
        touched.append(i)
        if s.groups == 1 or not hopeful:
            if s.total > capacity and not hopeful:
                return shards + 1, touched
            used, room = used + 1, capacity - s.total
        else:
            rest = s.total - room
            used += -(-rest // capacity)
            room = -rest % capacity
        if used > shards:
            break
    return used, touched


def smallest_capacity(spans: list[Span], shards: int) -> tuple[int, int]:
    """Bounds (least capacity that may do, least that surely does) from the spans' sums."""
    total, largest = sum(s.total for s in spans), max(s.largest for s in spans)

    def search(hopeful: bool, lo: int) -> int:
        hi = total
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if greedy(spans, mid, shards, hopeful)[0] <= shards else (mid + 1, hi)
        return lo

    low = search(True, max(largest, -(-total // shards)))
    return low, search(False, low)


def cut_points(groups: DataFrame, shards: int, first_parts: int = 8192, parts: int = 256) -> tuple[int, list[int]]:
    """Smallest feasible capacity, and the id of the first group of every shard but the first.

    groups: gid long (distinct, not null), size long. The driver holds 8192 sums at first, and 256 more for
    each interval that may hold a cut.
    """
    ends = groups.agg(F.min("gid").alias("lo"), F.max("gid").alias("hi")).first()
    if ends.lo is None:
        return 0, []
    spans = _spans(groups, [(ends.lo, ends.hi)], first_parts)
    while True:
        low, high = smallest_capacity(spans, shards)
        doubtful: set[int] = set()
        bound = [_ends(spans, c, shards, hopeful) for c, hopeful in ((low, False), (high, True))]
        for early, late in zip(*bound, strict=True):
            doubtful |= {i for i in range(early, late + 1) if spans[i].groups > 1}
        if not doubtful:
            break
        # A pass looks at so many intervals that the comparison still compiles to one method.
        order = sorted(doubtful)[:RANGES]
        fine = _spans(groups, [(spans[i].lo, spans[i].hi) for i in order], parts)
        gone = set(order)
        spans = sorted([s for i, s in enumerate(spans) if i not in gone] + fine, key=lambda s: s.lo)
    cuts, room = [], low
    for s in spans:
        if s.total > room:
            cuts.append(s.lo)
            room = low
        room -= s.total
    return low, cuts


def _ends(spans: list[Span], capacity: int, shards: int, hopeful: bool) -> list[int]:
    """Index of the span in which each of the shards ends (the last index for those that need not)."""
    out, room, last = [], capacity, len(spans) - 1
    for i, s in enumerate(spans):
        rest = s.total
        while rest > room and len(out) < shards:
            out.append(i)
            if s.groups == 1 or not hopeful:
                room = max(capacity, rest)
                break
            rest, room = rest - room, capacity
        room -= rest
    return (out + [last] * shards)[:shards]


def contiguous_shards(
    df: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", slot_rows: int = 64, slot_cells: int = 4096
) -> DataFrame:
    """Shard and slot of every row, with the largest shard as small as contiguous groups allow.

    Groups are rows of equal text, ordered by smallest id; a text of which no row has an id takes a hash of itself as its
    place. Slots count from 0 without gaps in each shard, in the order of a hash of the id (of rows without an id, of their place
    in the written table). Rows are numbered in cells of about slot_rows rows (at most slot_cells
    cells a shard), so that no task holds a whole shard.

    Returns id_col, size long, text_crc32 long (0 for null text, as it has no bytes), group_id, shard int, slot long; one row
    for each input row. Null texts are a group of their own; an empty table gives an empty result; rows with a null id are
    counted and placed like all others. Equal rows share a shard and get different slots.
    """
    text = F.col(text_col)
    rows = materialize(
        df.select(F.col(id_col).alias("id"), text_key(text).alias("tkey"), row_size(text).alias("size"), F.crc32(F.coalesce(text, F.lit(""))).cast("long").alias("crc")), "shard-rows"
    )
    gid = F.coalesce(F.min(F.col("id").cast("long")), F.xxhash64("tkey"))
    by_text = materialize(rows.groupBy("tkey").agg(gid.alias("gid"), F.sum("size").alias("gsize")), "shard-texts")
    groups = materialize(by_text.groupBy("gid").agg(F.sum("gsize").alias("size")), "shard-groups")
    _, cuts = cut_points(groups, shards)
    drop(groups)
    placed = rows.join(by_text.select("tkey", "gid"), "tkey")
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + F.when(F.col("gid") >= cut, 1).otherwise(0)
    placed = placed.withColumn("shard", shard.cast("int")).withColumn("h", F.xxhash64("id", "tkey", F.lit(7)))
    placed = materialize(placed.select("id", "size", "crc", "gid", "shard", "h"), "shard-placed")
    drop(rows)
    drop(by_text)

    counts = {r.shard: r["count"] for r in placed.groupBy("shard").count().collect()}
    cells = F.lit(1)
    for s, n in sorted(counts.items()):
        cells = F.when(F.col("shard") == s, max(1, min(slot_cells, n // slot_rows))).otherwise(cells)
    place = F.xxhash64("_metadata.file_name", "_metadata.row_index")  # apart also for rows that are equal
    celled = placed.withColumn("h", F.when(F.col("id").isNull(), place).otherwise(F.col("h"))).withColumn("cell", F.pmod(F.col("h"), cells).cast("int"))
    sums = celled.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    # At most shards * slot_cells rows, whatever the input.
    offsets = F.broadcast(sums.select("shard", "cell", F.coalesce(before, F.lit(0)).alias("offset")))
    within = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("h", "id", "size"))
    numbered = celled.withColumn("k", within).join(offsets, ["shard", "cell"])
    return numbered.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.col("gid").alias("group_id"), "shard", (F.col("offset") + F.col("k") - 1).alias("slot")
    )
