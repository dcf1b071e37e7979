"""Benchmark decontamination by spaced-seed hashing.

A spaced seed hashes the words at a mask's ones and ignores those at its zeros, so a replaced word breaks
fewer hashes than it breaks of contiguous word n-grams. Test hashes are a table. One pass over the training texts
computes the hash of every position; a bit filter of the test hashes, of bounded size, lets the likely ones through, and
these are joined with the table. Hits are counted by text, item and diagonal; along each diagonal the two texts are laid on
each other and the overlap is verified, with replaced words allowed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, fresh, mark, materialize, release, sent_if_small

#: Weight 6 each; the zeros of one are ones of another.
MASKS = ("1110111", "110101011", "1011001101")
#: Scripts written without spaces (Thai to Khmer, kana, Han): each character is a word.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
_UNSPACED = re.compile(f"[{UNSPACED}]")
_WORD = re.compile(r"\w+")
_MIXED = re.compile(rf"[{UNSPACED}]|[^\W{UNSPACED}]+")
#: Bits of the filter at most (32 MB), for each test hash, and the shifts of a hash that give its places.
FILTER_BITS, BITS_PER_HASH, SHIFTS = 1 << 28, 32, (0, 18, 36)
#: Items verified with one copy of a text.
ITEMS_AT_ONCE = 64


def words_of(text: str | None) -> list[str]:
    """Words of a text, lower-cased: runs of word characters; single characters of unspaced scripts."""
    low = (text or "").lower()
    return (_WORD if low.isascii() or not _UNSPACED.search(low) else _MIXED).findall(low)


class _Codes(dict):
    """64-bit hash of each word seen."""

    def __missing__(self, word: str) -> int:
        from xxhash import xxh64_intdigest

        code = self[word] = xxh64_intdigest(word)
        return code


class Seeds:
    """Words and spaced-seed hashes of texts."""

    def __init__(self, masks: tuple[str, ...]):
        self.spans = [len(m) for m in masks]
        self.offsets = [[i for i, c in enumerate(m) if c == "1"] for m in masks]
        # A mask's hashes are its own, wherever it stands in the list.
        self.starts = [1469598103934665603 + 7919 * int(m, 2) for m in masks]
        self.words = _Codes()

    def codes(self, text: str | None):
        """64-bit hashes of the words of a text."""
        import numpy as np

        words, known = words_of(text), self.words
        if len(known) > 200_000:
            known.clear()
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))

    def hashes(self, tokens, mask: int):
        """Hash of each position at which the mask fits."""
        import numpy as np

        n = len(tokens) - self.spans[mask] + 1
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        out = np.full(n, self.starts[mask], dtype=np.uint64)
        for i in self.offsets[mask]:
            out = (out ^ tokens[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out


def masks_for(words: int, masks: tuple[str, ...]) -> tuple[str, ...]:
    """Masks of an item with so many words: those that fit, or for an item shorter than all of them the whole item."""
    return tuple(m for m in masks if len(m) <= words) if words >= min(map(len, masks)) else ("1" * words,) * (words > 0)


def words_needed(words: int, masks: tuple[str, ...], min_words: int) -> int:
    """Words of an overlap with an item of so many words."""
    return words if words < min(map(len, masks)) else min(min_words, -(-words * 4 // 5))


def longest_overlap(same, share: float) -> tuple[int, int] | None:
    """The longest run [a, b) that starts and ends with an equal word and has at least that share of equal words; ties: the first."""
    import numpy as np

    equal = np.nonzero(same)[0]
    if not len(equal):
        return None
    # equal count minus share * length, kept in integers: a run is good if its end's value is not below its start's.
    sums = np.concatenate(([0], np.cumsum(np.where(same, 1000, 0) - round(share * 1000))))
    least = np.minimum.accumulate(sums[:-1])
    best = None
    for end in (equal[::-1] + 1).tolist():
        if best and end < best[1] - best[0]:
            break
        start = int(np.argmax(least[:end] <= sums[end])) if least[end - 1] <= sums[end] else -1
        if start >= 0 and (best is None or end - start >= best[1] - best[0]):
            start += int(np.argmax(same[start:end]))
            if best is None or end - start >= best[1] - best[0]:
                best = (start, end)
    return best


def verified(tokens, own, shifts: list[tuple[int, int]], need: int, share: float) -> tuple[int, int, int, int, int] | None:
    """(words, equal, text_from, item_from, hits) of the longest overlap along the diagonals (shift, hits); ties: the first in the text."""
    best = None
    for shift, hits in shifts:
        lo, hi = max(0, -shift), min(len(own), len(tokens) - shift)
        same = own[lo:hi] == tokens[lo + shift : hi + shift]
        found = longest_overlap(same, share)
        if found and found[1] - found[0] >= need:
            a, b = found
            row = (b - a, int(same[a:b].sum()), a + lo + shift, a + lo, hits)
            if best is None or (row[0], -row[2], -row[3]) > (best[0], -best[2], -best[3]):
                best = row
    return best


def test_items(benchmark: DataFrame, item_col: str, text_col: str, masks: tuple[str, ...]) -> DataFrame:
    """Distinct item texts (item: a hash of the text) with their words and seeds (h, place)."""
    longs, ints = T.ArrayType(T.LongType()), T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("words", longs), T.StructField("h", longs), T.StructField("place", ints)])

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = Seeds(()).codes(text)
                seeds = Seeds(masks_for(len(tokens), masks))
                h = [seeds.hashes(tokens, k) for k in range(len(seeds.spans))]
                flat = np.concatenate(h) if h else np.zeros(0, dtype=np.uint64)
                rows.append((item, tokens.view(np.int64).tolist(), flat.view(np.int64).tolist(), [p for part in h for p in range(len(part))]))
            columns = list(zip(*rows)) if rows else [[]] * 4
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=schema.names)

    texts = benchmark.select(F.xxhash64(text_col).alias("item"), F.col(text_col).alias("t")).where("t is not null").dropDuplicates(["item"])
    return arrow_map(texts, run, schema)


def bit_filter(hashes: DataFrame, bits: int):
    """Bits set at three places of each hash h, as an array of 64-bit words. The driver holds the words that aren't empty."""
    import numpy as np

    at = F.explode(F.array(*[F.shiftrightunsigned("h", s).bitwiseAND(F.lit(bits - 1)) for s in SHIFTS]))
    places = hashes.select(at.alias("at")).select(F.shiftright("at", 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
    rows = places.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(max(1, bits >> 6), dtype=np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def training_hits(texts: DataFrame, table, masks: tuple[str, ...]) -> DataFrame:
    """(s0, s1, h, at): positions of texts (s0, s1, text) whose hash passes the filter."""
    schema = T.StructType([texts.schema["s0"], texts.schema["s1"], T.StructField("h", T.LongType(), False), T.StructField("at", T.IntegerType(), False)])
    shipped = texts.sparkSession.sparkContext.broadcast(table)  # bounded by FILTER_BITS

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        seeds, filled = Seeds(masks), shipped.value
        last, low, one = np.uint64(len(filled) * 64 - 1), np.uint64(63), np.uint64(1)
        # The filter folded to 16 bits of place, small enough for the cache: most positions end here.
        coarse = np.unpackbits(np.bitwise_or.reduce(filled.reshape(-1, 1024), axis=0).view(np.uint8), bitorder="little").astype(bool)

        def passes(h, shift: int):
            at = h >> np.uint64(shift) & last
            return (filled[(at >> np.uint64(6)).astype(np.int64)] >> (at & low) & one).astype(bool)

        for batch in batches:
            rows, hashes, places = [], [], []
            for i, text in enumerate(batch.column(2)):
                tokens = seeds.codes(text.as_py())
                for k in range(len(seeds.spans)):
                    h = seeds.hashes(tokens, k)
                    at = np.nonzero(coarse[(h & np.uint64(0xFFFF)).astype(np.int64)])[0]
                    for shift in SHIFTS:
                        at = at[passes(h[at], shift)]
                    if len(at):
                        rows.append(np.full(len(at), i))
                        hashes.append(h[at])
                        places.append(at)
            if rows:
                keep = pa.array(np.concatenate(rows))
                found = pa.array(np.concatenate(hashes).view(np.int64)), pa.array(np.concatenate(places).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep), *found], names=schema.names)

    return arrow_map(texts.select("s0", "s1", "text"), run, schema)


def stamps(text: Column) -> list[Column]:
    """128 bits that tell texts apart."""
    return [F.xxhash64(text).alias("s0"), F.xxhash64(text, F.lit(1)).alias("s1")]


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    masks: tuple[str, ...] = MASKS,
    min_words: int = 13,
    min_share: float = 0.8,
) -> DataFrame:
    """Verified overlaps of documents with benchmark items.

    An overlap is a run of aligned words, at least min_share of them equal, of at least min_words words (or
    80 % of a shorter item). Words are runs of word characters, lower-cased; in scripts without spaces each character is
    one. Items shorter than the shortest mask (7 words) are found only as a whole, with every word equal; items without
    words are never found. Of several overlaps with an item the longest is returned, then the first.

    Returns id_col, item_id, words, equal_words, doc_from, item_from (word positions from 0), hits; one row for each
    document row and benchmark row that overlap, so repeated rows repeat. Null and empty texts, an empty benchmark
    or an empty table give no rows.

    Hits of equal texts are counted once, by text, item and diagonal. Only texts with hits are read again; they are
    shuffled only if the table of hits is too large to broadcast. No hit or diagonal is left out.
    """
    before = mark()
    benchmark = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("t")).where("t is not null")
    items = materialize(test_items(benchmark, "item_id", "t", masks), "leak-items")
    seeds = materialize(items.select("item", F.explode(F.arrays_zip("h", "place")).alias("s")).select("item", "s.h", "s.place"), "leak-seeds")
    least = min(map(len, masks))
    short = [r.n for r in items.select(F.size("words").alias("n")).where((F.col("n") > 0) & (F.col("n") < least)).distinct().collect()]
    bits = 1 << 16
    while bits < min(FILTER_BITS, BITS_PER_HASH * seeds.count()):
        bits *= 2
    texts = docs.where(F.col(text_col).isNotNull()).select(*stamps(F.col(text_col)), F.col(text_col).alias("text"))
    hits = training_hits(texts, bit_filter(seeds, bits), (*masks, *("1" * n for n in sorted(short))))
    hits = materialize(hits, "leak-hits").distinct()
    diagonals = hits.join(seeds, "h").groupBy("s0", "s1", "item", (F.col("at") - F.col("place")).alias("shift")).agg(F.count("*").cast("int").alias("hits"))
    pairs = materialize(diagonals.groupBy("s0", "s1", "item").agg(F.collect_list(F.struct("shift", "hits")).alias("shifts")), "leak-pairs")
    counts = pairs.groupBy("s0", "s1").agg(F.ceil(F.count("*") / ITEMS_AT_ONCE).alias("parts"))
    packs = pairs.join(items.select("item", F.col("words").alias("own")), "item").join(counts, ["s0", "s1"])
    packs = packs.groupBy("s0", "s1", F.pmod(F.xxhash64("item"), F.col("parts")).alias("part")).agg(F.collect_list(F.struct("item", "own", "shifts")).alias("pack"))
    packs = materialize(packs.select("s0", "s1", "pack"), "leak-packs")
    weight = F.aggregate("pack", F.lit(64), lambda n, p: n + 64 + 8 * (F.size(p["own"]) + F.size(p["shifts"])))
    own_texts = docs.select(F.col(id_col), F.col(text_col).alias("text"), *stamps(F.col(text_col))).join(sent_if_small(packs, weight), ["s0", "s1"]).select(id_col, "text", "pack")
    ints = ("words", "equal_words", "doc_from", "item_from", "hits")
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("item", T.LongType()), *(T.StructField(c, T.IntegerType(), False) for c in ints)])

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        worker = Seeds(())
        for batch in batches:
            at, rows = [], []
            for i, (text, pack) in enumerate(zip(batch.column(1), batch.column(2))):
                tokens = worker.codes(text.as_py())
                for p in pack.as_py():
                    own = np.array(p["own"], dtype=np.int64).view(np.uint64)
                    short = len(own) < least
                    shifts = [(s["shift"], s["hits"]) for s in p["shifts"]]
                    found = verified(tokens, own, shifts, words_needed(len(own), masks, min_words), 1.0 if short else min_share)
                    if found:
                        at.append(i)
                        rows.append((p["item"], *found))
            columns = list(zip(*rows)) if rows else [[]] * 6
            made = [pa.array(c, pa.int32()) for c in columns[1:]]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(columns[0], pa.int64()), *made], names=schema.names)

    found = arrow_map(own_texts, run, schema)
    named = benchmark.select("item_id", F.xxhash64("t").alias("item"))
    release(before, packs)
    return found.join(named, "item").select(id_col, "item_id", *ints)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """docs without the documents whose text overlaps with a benchmark item; see :func:`overlaps`.

    Each row goes or stays by its own text, whatever its id, null ids too; null texts stay. All columns are kept.
    """
    name, stamp = fresh(docs, "__leaked"), F.xxhash64(F.col(text_col), F.col(text_col).isNull())
    found = overlaps(docs.select(stamp.alias(name), F.col(text_col).alias("text")), benchmark, name, "text", **settings)
    found = materialize(found.select(name).distinct(), "leaked-texts")
    return docs.join(sent_if_small(found, 48), stamp == F.col(name), "left_anti")
