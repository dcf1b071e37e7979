"""URL verdicts: host and path rules first, then a list of canonical URLs behind a blocked Bloom filter.

Everything is a DataFrame expression. The filter is a small table: one row for each 512-bit block, eight
64-bit words in a row. A key selects one block and sets one bit in each word. Most URLs end at the filter;
possible hits go on to an exact hash join with the list, which removes the false positives.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

WORDS, WORD_BITS = 8, 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
TRACKING = r"(?<=[?&])(?:utm_[a-z]+|ref|fbclid|gclid)=[^&]*(?:&|$)"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host and its subdomains, if the path starts with the rule's."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or no ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without closing slashes, query without tracking parameters; no scheme, no fragment.

    Empty for null and for text without ``://``.
    """
    query = F.regexp_replace(F.coalesce(F.regexp_extract(url, PARTS, 3), F.lit("")), TRACKING, "")
    return F.concat(
        F.regexp_replace(host_of(url), r"^www\.", ""),
        F.regexp_replace(path_of(url), "/+$", ""),
        F.regexp_replace(query, "[?&]$", ""),
    )


def rule_text(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as text; null if none does."""
    out = None
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, rule.text) if out is None else out.when(fits, rule.text)
    return F.lit(None).cast("string") if out is None else out


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    """The bit of each word, six bits of a second hash at a time."""
    second = F.xxhash64(key, F.lit("bit"))
    return [F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(WORD_BITS - 1)).cast("int") for i in range(WORDS)]


def build_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """Filter blocks (block, w0..w7) of a column of keys; each task combines its own bits before the shuffle."""
    bits = _bits(F.col(key))
    words = [F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bits[i])).alias(f"w{i}") for i in range(WORDS)]
    return keys.groupBy(_block(F.col(key), blocks).alias("block")).agg(*words)


def blocks_for(keys: int, bits_per_key: int) -> int:
    """Blocks that hold so many keys."""
    return max(1, -(-keys * bits_per_key // (WORDS * WORD_BITS)))


def judge_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    listed_col: str = "url",
    bits_per_key: int = 16,
    broadcast_bytes: int = 16 << 20,
) -> DataFrame:
    """Host, path, rule and verdict of every URL.

    A fitting rule decides (the longest wins). Without one, a URL is blocked exactly if its canonical form
    is that of a listed URL. The filter is broadcast only if its size, known from the count of listed keys,
    is at most broadcast_bytes; a larger one is joined by block.

    Returns id_col, host, path, rule, verdict, canonical; one row for each input row, so repeated rows stay
    repeated. Null URLs and text without ``://`` have empty parts, fit no rule and are allowed: the empty
    canonical form is never listed. With an empty list every URL without a rule is allowed. Other columns
    are left out.
    """
    keys = materialize(
        listed.select(canonical(F.col(listed_col)).alias("key")).where(F.col("key") != "").distinct(), "url-keys"
    )
    blocks = blocks_for(keys.count(), bits_per_key)
    cells = build_filter(keys, "key", blocks)
    if blocks * (WORDS + 1) * 8 <= broadcast_bytes:
        cells = F.broadcast(cells)
    else:
        cells = materialize(cells, "url-filter")

    url = F.col(url_col)
    judged = pages.select(F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("canonical"))
    judged = judged.withColumn("rule", rule_text(F.col("host"), F.col("path"), rules))
    by_rule = F.lit(None).cast("string")
    for verdict in ("allow", "block"):
        texts = [r.text for r in rules if r.verdict == verdict]
        by_rule = F.when(F.col("rule").isin(texts), verdict).otherwise(by_rule)

    all_set = F.col("w0").isNotNull()
    for i, bit in enumerate(_bits(F.col("canonical"))):
        all_set &= F.call_function("shiftright", F.col(f"w{i}"), bit).bitwiseAND(F.lit(1)) == 1
    probed = judged.withColumn("block", _block(F.col("canonical"), blocks)).join(cells, "block", "left")
    probed = probed.withColumn("possible", F.coalesce(all_set & F.col("rule").isNull() & (F.col("canonical") != ""), F.lit(False)))
    out = [F.col(c) for c in (id_col, "host", "path", "rule", "canonical", "possible")]
    probed = materialize(probed.select(*out), "url-probed")  # the pages are read and taken apart once
    passed = probed.where(~F.col("possible")).select(*out, F.lit(False).alias("exact"))
    hits = (
        probed.where("possible").select(*out).join(keys.select(F.col("key").alias("canonical"), F.lit(True).alias("in_list")), "canonical", "left")
    ).select(*out, F.coalesce("in_list", F.lit(False)).alias("exact"))
    return passed.unionByName(hits).select(
        id_col, "host", "path", "rule", F.coalesce(by_rule, F.when(F.col("exact"), "block").otherwise("allow")).alias("verdict"), "canonical"
    )
