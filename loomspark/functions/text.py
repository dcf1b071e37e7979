"""Text rules as column expressions; Arrow UDFs only for Unicode normal forms, case folding and edit ratios."""

from __future__ import annotations

import difflib
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# What counts as white space at the ends of a text, and replacements in their order.
SPACE = r"[\t\n\x0b\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LITERALS = (
    ("\t", ""),
    ("[n]", ""),
    (r"\[n\]", ""),
    ("　", ""),
    ("？", "?"),
    ("！", "!"),
    ("♥", "♡"),
    ("●", "○"),
    ("◯", "○"),
    ("〇", "○"),
)
PATTERNS = (
    (r"[;▼♀♂《》≪≫①②③④⑤⑥]", ""),
    (r"[\x{02d7}\x{2010}-\x{2015}\x{2043}\x{2212}\x{23af}\x{23e4}\x{2500}\x{2501}\x{2e3a}\x{2e3b}]", ""),
    (r"[\x{ff5e}\x{301c}]", "ー"),
    (r"…{3,}", "……"),
)
BRACKETS = {"「": "」", "『": "』", "（": "）", "【": "】", "(": ")"}
ANNOTATION_EMOJIS = (
    "⏩ ⏱️ ⏸️ 🌬️ 🍭 🎛️ 🎭 🎵 🐢 🐱 👂 👃 👅 👌 👏 💋 💥 💦 💪 📄 📞 📢 📣 😆 😊 😌 😎 😏 😒 😖 😟 😠 😪 😭 😮 😮‍💨 😰 😱 😲 😴 "
    "🙄 🙏 🤐 🤔 🤢 🤧 🤭 🥤 🥱 🥴 🥵 🥹 🥺 🫣 🫶 📖"
).split()


def strip(text: Column) -> Column:
    """Without white space at both ends (all of Unicode's, not only U+0020)."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def collapse_whitespace(text: Column) -> Column:
    """Inline blanks become one space, then runs of line breaks one space; in two passes, so ``a \\n b`` keeps three."""
    return strip(F.regexp_replace(F.regexp_replace(strip(text), r"[ \t\r\f\x0b]+", " "), r"\n+", " "))


@F.pandas_udf(StringType())
def _nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


@F.pandas_udf(StringType())
def _nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


@F.pandas_udf(StringType())
def _casefolded(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else t.casefold())


def beyond_ascii(text: Column, change, plain=lambda t: t) -> Column:
    """A change that Spark lacks, for texts beyond ASCII only; ASCII texts reach Python as nulls and stay, or change by `plain`."""
    return F.coalesce(change(F.when(text.rlike(r"[^\x00-\x7f]"), text)), plain(text))


def nfc(text: Column) -> Column:
    """Unicode normal form C."""
    return beyond_ascii(text, _nfc)


def nfkc(text: Column) -> Column:
    """Unicode normal form KC."""
    return beyond_ascii(text, _nfkc)


def casefolded(text: Column) -> Column:
    """Case-folded text, for sort keys and comparison."""
    return beyond_ascii(text, _casefolded, F.lower)


def normalize_transcript(text: Column) -> Column:
    """NFC, then :func:`collapse_whitespace`."""
    return collapse_whitespace(nfc(text))


def meaningful(text: Column) -> Column:
    """Letters, marks and numbers of a text."""
    return F.regexp_replace(text, r"[^\p{L}\p{M}\p{N}]+", "")


def peel_brackets(text: str) -> str:
    """Removes bracket pairs that enclose the whole text; only the same kind of pair counts for depth."""
    while len(text) > 1 and BRACKETS.get(text[0]) == text[-1]:
        opened, closed, depth = text[0], text[-1], 0
        for at, c in enumerate(text):
            depth += (c == opened) - (c == closed)
            if not depth:
                break
        if depth or at < len(text) - 1:
            return text
        text = text[1:-1]
    return text


@F.pandas_udf(StringType())
def _peeled_nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", peel_brackets(t)))


def normalize_text(text: Column) -> Column:
    """Literal replacements, patterns, enclosing brackets, NFKC, and dots folded to an ellipsis, in this order."""
    for old, new in LITERALS:
        text = F.replace(text, F.lit(old), F.lit(new))
    for pattern, new in PATTERNS:
        text = F.regexp_replace(text, pattern, new)
    text = _peeled_nfkc(text)
    return F.replace(F.replace(text, F.lit("..."), F.lit("…")), F.lit(".."), F.lit("…"))


@F.pandas_udf(StringType())
def compact(text: pd.Series) -> pd.Series:
    """Case-folded content characters of the NFKC form, for similarity."""

    def one(t: str | None) -> str | None:
        if t is None:
            return None
        return "".join(c.casefold() for c in unicodedata.normalize("NFKC", t) if unicodedata.category(c)[0] not in "PSZC")

    return text.map(one)


@F.pandas_udf(DoubleType())
def similarity(before: pd.Series, after: pd.Series) -> pd.Series:
    """Gestalt ratio of two compact texts; not symmetric, so the order (before, after) matters."""
    return pd.Series([None if a is None or b is None else difflib.SequenceMatcher(None, a, b).ratio() for a, b in zip(before, after)], dtype="float64")


def sanitize_id(raw: Column, fallback: str) -> Column:
    """An identifier part: blanks to ``_``, separators to ``-``, other characters to ``-``, at most 96 characters."""
    value = strip(F.coalesce(raw, F.lit("")))
    s = F.regexp_replace(nfkc(value), r"(?U)\s+", "_")
    return _sanitized(value, s, fallback)


def sanitize_id_ascii(raw: Column, fallback: str) -> Column:
    """:func:`sanitize_id` for text that is its own NFKC form; without a UDF."""
    value = strip(F.coalesce(raw, F.lit("")))
    return _sanitized(value, F.regexp_replace(value, r"(?U)\s+", "_"), fallback)


def _sanitized(value: Column, s: Column, fallback: str) -> Column:
    s = F.regexp_replace(s, r"[:/\\]+", "-")
    s = F.regexp_replace(s, r"[\x00-\x1f\x7f]", "")
    s = F.regexp_replace(s, r"(?U)[^\w.\-]+", "-")
    s = F.regexp_replace(F.regexp_replace(s, "-{2,}", "-"), r"^[-_.]+|[-_.]+$", "")
    s = F.when(s == "", F.substring(F.sha1(value), 1, 16)).otherwise(s)
    s = F.when(F.length(s) > 96, F.concat(F.substring(s, 1, 80), F.lit("-"), F.substring(F.sha1(s), 1, 10))).otherwise(s)
    return F.when(value == "", F.lit(fallback)).otherwise(s)


def sanitize_component(raw: Column, fallback: str, max_length: int) -> Column:
    """A path part: like :func:`sanitize_id`, but runs of ``-`` and ``_`` become ``_`` and the length is cut."""
    s = F.regexp_replace(strip(nfkc(raw)), r"(?U)\s+", "_")
    s = F.regexp_replace(F.regexp_replace(s, r'[<>:"/\\|?*\x00-\x1f]', "-"), r"(?U)[^\w.\-]+", "-")
    s = F.regexp_replace(F.regexp_replace(s, "[-_]{2,}", "_"), r"^[-_.]+|[-_.]+$", "")
    s = F.when(s == "", F.lit(fallback)).otherwise(s)
    s = F.when(F.length(s) > max_length, F.regexp_replace(F.substring(s, 1, max_length), r"[-_.]+$", "")).otherwise(s)
    return F.when(s == "", F.lit(fallback)).otherwise(s)


def source_id(path: Column) -> Column:
    """Top folder, stem and a digest of the whole path."""
    top = F.regexp_extract(path, r"^([^/]*)/", 1)
    stem = F.regexp_extract(path, r"([^/]*?)(?:\.[^./]*)?$", 1)
    return F.concat_ws("_", sanitize_component(top, "root", 16), sanitize_component(stem, "file", 24), F.substring(F.sha1(path), 1, 10))


def clip_id(source: Column, start_seconds: Column, end_seconds: Column, infix: str = "") -> Column:
    """Source and millisecond bounds (rounded half to even), ten digits each."""
    ms = lambda c: F.bround(c * 1000).cast("long")
    return F.format_string(f"%s{infix}_%010d_%010d", source, ms(start_seconds), ms(end_seconds))


def log1p_cap(value: Column, cap: float) -> Column:
    """log1p of a value held in [0, cap], as a share of log1p(cap)."""
    return F.log1p(F.least(F.greatest(value.cast("double"), F.lit(0.0)), F.lit(float(cap)))) / F.log1p(F.lit(float(cap)))


def occurrences(text: Column, *literals: str) -> Column:
    """How often the single characters occur."""
    return F.length(text) - F.length(F.translate(text, "".join(literals), ""))


def emoji_count(text: Column) -> Column:
    """Annotation emojis, longest sequence first. Most texts have no character of their blocks and end at one scan."""
    count = F.regexp_count(text, F.lit("|".join(sorted(map(re.escape, ANNOTATION_EMOJIS), key=len, reverse=True))))
    return F.when(text.rlike(r"[\x{23e9}-\x{23f8}\x{1f300}-\x{1faff}]"), count).otherwise(F.when(text.isNotNull(), 0))


def duration_features(text: Column, tokens: Column, has_speaker: Column, max_tokens: int) -> Column:
    """The 14 duration features of a text, in their fixed order, as array<double>."""
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    share = lambda chars_of: (F.length(text) - F.length(F.regexp_replace(text, f"{chars_of}+", ""))) / chars
    return F.array(
        F.least(F.greatest(tokens.cast("double"), F.lit(0.0)), F.lit(float(max_tokens))) / F.lit(float(max_tokens)),
        log1p_cap(chars, 512),
        tokens / chars,
        log1p_cap(occurrences(text, "。", "."), 8),
        log1p_cap(occurrences(text, "、", ","), 16),
        log1p_cap(occurrences(text, "ー"), 8),
        log1p_cap(occurrences(text, "…"), 8),
        log1p_cap(occurrences(text, "！", "!"), 8),
        log1p_cap(occurrences(text, "？", "?"), 8),
        log1p_cap(emoji_count(text), 8),
        share(r"[\x{3040}-\x{30ff}]"),
        share(r"[\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}\x{20000}-\x{2fa1f}]"),
        share("[0-9A-Za-z]"),
        F.when(has_speaker, 1.0).otherwise(0.0),
    )


def json_from_text(text: Column) -> Column:
    """A JSON object in free text: the whole, else a fenced block, else from the first ``{`` to the last ``}``; null if none parses."""
    whole = F.trim(text)
    tries = [whole, F.regexp_extract(text, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1), F.regexp_extract(text, r"(?s)(\{.*\})", 1)]
    good = [F.when(F.try_parse_json(t).isNotNull() & F.startswith(t, F.lit("{")), t) for t in tries]
    return F.coalesce(*good)


def optional_float(text: Column) -> Column:
    """A number, or null for null, none, off, disable and disabled; anything else is an error."""
    word = F.lower(strip(text))
    return F.when(word.isin("none", "null", "off", "disable", "disabled"), F.lit(None)).otherwise(word.cast("double"))
