"""Replacement of personal data by keyed surrogates of the same type and format.

The canonical form of an entity (a phone number's digits, a lower-cased address) is a number in a domain
made of its format: digits stay digits, letters keep script, case and vowel or consonant class, given
names stay in their script and gender, and family names keep an ending that shows gender. A keyed permutation P of the domain without fixed points,
P(x) = F'(F(x) + 1) for a Feistel network F and its inverse F', gives the surrogate. So within a format
different entities get different surrogates, the same entity gets the same one in every document, and
none keeps its value; surrogates keep the format, so those of different formats differ too.
Mail domains and names can still meet across formats, so :func:`replace_checked` checks a run's results with
:func:`collisions` and takes another key if there are any.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from math import isqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, drop, materialize

ROUNDS = 6
#: Given names by script and gender; each list is one domain. Production passes longer ones.
GIVEN = {
    ("latin", "f"): "Aisha Alice Amina Ana Anna Barbara Carla Carmen Caroline Charlotte Chiara Claudia Deepa Diana Elena Emily Emma Eva Fatima Giulia Ingrid Julia Katarzyna Laura Leila Linda Lisa Lucia Magdalena Maria Marie Martha Mei Monica Nina Olivia Priya Sandra Sarah Sofia Sophie Susan Teresa Ursula Victoria Yuki".split(),
    ("latin", "m"): "Adam Ahmed Albert Alexander Andrew Anthony Antonio Arjun Carlos Charles Christian Daniel David Edward Felix Francis George Giovanni Hans Henry Hiroshi Jacob James John Jorge Joseph Juan Karl Lars Louis Lucas Luigi Michael Mohammed Oliver Omar Paul Pedro Peter Piotr Raj Robert Thomas Wei William Yusuf".split(),
    ("cyrillic", "f"): "Александра Анна Вера Елена Ирина Мария Наталья Ольга Светлана Татьяна".split(),
    ("cyrillic", "m"): "Александр Алексей Андрей Дмитрий Иван Михаил Николай Павел Сергей Юрий".split(),
    ("greek", "f"): "Αικατερίνη Ελένη Ειρήνη Μαρία Σοφία".split(),
    ("greek", "m"): "Αλέξανδρος Γιώργος Γιάννης Δημήτρης Νίκος".split(),
}
#: Endings of family names that show gender, as pairs (masculine, feminine); both forms are one family.
GENDERED = (("ский", "ская"), ("цкий", "цкая"), ("ов", "ова"), ("ев", "ева"), ("ёв", "ёва"), ("ин", "ина"), ("ski", "ska"), ("cki", "cka"), ("όπουλος", "οπούλου"), ("ίδης", "ίδου"))
#: Words within a family name, and titles before a name.
PARTICLES = "al bin bint da de del della den der di dos du el la le ten ter van von".split()
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Herrn Señor Señora Sr Sra Monsieur Madame Mme Mlle Signor Signora Pan Pani господин госпожа г-н г-жа κύριος κυρία".split()
#: Domains of mail addresses that don't tell a person.
SHARED_DOMAINS = ("example.com", "example.net", "example.org", "gmail.com", "hotmail.com", "icloud.com", "outlook.com", "proton.me", "yahoo.com")
#: Letter classes; a letter's surrogate comes from its own class.
CLASSES = ("0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщъь", "äöü", "àâéèêëîïôùûç", "áíóúñ")

#: Function words of the language that writes all nouns large.
GERMAN = frozenset("auch auf aus bei das dem den der ein eine einem einen für im ist mit nicht nur sind und viele vom wird zu zum".split())

_OF = {c: k for k in CLASSES for c in k}


@lru_cache(maxsize=4096)
def letter_class(c: str) -> str | None:
    """Characters that may stand for a lower-case letter or digit: its class, or its neighbours of 32 code points that are
    letters of its category with an upper case of their own if it has one. None for other characters."""
    if c in _OF:
        return _OF[c]
    if c.isdecimal():
        return "".join(chr(ord(c) - int(c) + d) for d in range(10))
    if not c.isalpha():
        return None
    cased = lambda x: len(x.upper()) == 1 and x.upper() != x and x.upper().lower() == x
    for width in (32, 256):
        low = ord(c) // width * width
        near = [x for x in map(chr, range(low, low + width)) if x == c or x not in _OF and unicodedata.category(x) == unicodedata.category(c) and cased(x) == cased(c)]
        if len(near) > 1:
            return "".join(near)
    return None


_EMAIL = re.compile(r"[\w.+-]+@(?:[\w-]+\.)+[A-Za-z]{2,}")
_NUMBER = re.compile(
    r"(?=[\d+(])(?:(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<card>(?<!\d)[3-6]\d{3}(?:[ -]?\d{4}){3}(?!\d)|(?<!\d)3[47]\d{2}[ -]?\d{6}[ -]?\d{5}(?!\d))"
    r"|(?P<phone>\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)|\+(?!1[ .(-])\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?![.-]?\d)|\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])))"
)
_IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?\b")
_BIG = "A-ZÀ-ÖØ-ÞĀ-ſΆ-ΫЀ-Я"
_NAME = rf"[{_BIG}](?:\w+|['’](?=[{_BIG}])\w+)(?:['’-](?=[{_BIG}])\w+)*"
_FAMILY = rf"((?:[ \u00a0]+(?:{_NAME}|[{_BIG}]\.))?(?:[ \u00a0]+(?:{'|'.join(PARTICLES)}))*[ \u00a0]+{_NAME})(?!\w)"
_TITLED = re.compile(rf"(?:{'|'.join(TITLES)})\.?[ \u00a0]+$|(?<!\w)[{_BIG}]\.[ \u00a0]*$")


def person_pattern(given: dict) -> re.Pattern:
    """A listed given name and what follows it as a family name: further names, initials, particles."""
    by_first: dict[str, list[str]] = {}
    for name in sorted(n for names in given.values() for n in names):
        by_first.setdefault(name[0], []).append(re.escape(name[1:]))
    return re.compile(r"(?<!\w)((?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in by_first.items()) + r"))" + _FAMILY)


def writes_nouns_large(text: str) -> bool:
    """Whether the text is German, where capital letters don't mark names: one word of fifteen is one of its function words."""
    words = re.findall(r"\w+", text)
    return sum(w in GERMAN for w in words) * 15 >= len(words) > 0


class Surrogates:
    """Detects entities in a text and replaces them under a secret key."""

    def __init__(self, key: bytes, given: dict[tuple[str, str], list[str]] = GIVEN):
        self.key, self.names = key, given
        self.place = {name: (kind, i) for kind, names in given.items() for i, name in enumerate(names)}
        self.person = person_pattern(given)
        self._memo: dict[tuple[str, str], str] = {}

    def permuted(self, x: int, size: int, tweak: str) -> int:
        """A keyed permutation of range(size) without fixed points (for a size over 1)."""
        if size < 2:
            return x
        half = isqrt(size - 1) + 1
        bytes_ = (half.bit_length() + 7) // 8 + 8

        def mix(r: int, v: int) -> int:
            word = b"%d|%d|%s|%d" % (r, size, tweak.encode(), v)
            return int.from_bytes(blake2b(word, key=self.key, digest_size=min(64, bytes_)).digest(), "big") % half

        def forward(v: int) -> int:
            while True:
                a, b = divmod(v, half)
                for r in range(ROUNDS):
                    a, b = b, (a + mix(r, b)) % half
                v = a * half + b
                if v < size:
                    return v

        def back(v: int) -> int:
            while True:
                a, b = divmod(v, half)
                for r in reversed(range(ROUNDS)):
                    a, b = (b - mix(r, a)) % half, a
                v = a * half + b
                if v < size:
                    return v

        return back((forward(x) + 1) % size)

    def spelled(self, text: str, tweak: str) -> str:
        """Every letter and digit of a text changed within its class, case kept; other characters stay."""
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        kinds = [letter_class(c) for c in low]
        places = [(i, kind) for i, kind in enumerate(kinds) if kind]
        value, size = 0, 1
        for i, kind in places:
            value, size = value * len(kind) + kind.index(low[i]), size * len(kind)
        shape = "".join("%06x" % ord(kind[0]) if kind else c for c, kind in zip(low, kinds))
        value = self.permuted(value, size, f"{tweak}:{shape}")
        out = list(text)
        for i, kind in reversed(places):
            value, k = divmod(value, len(kind))
            out[i] = kind[k].upper() if text[i] != low[i] else kind[k]
        return "".join(out)

    def digits(self, digits: str, tweak: str) -> str:
        return "%0*d" % (len(digits), self.permuted(int(digits), 10 ** len(digits), f"{tweak}:{len(digits)}")) if digits else ""

    # Canonical forms in, canonical surrogates out.

    def email(self, value: str) -> str:
        local, _, domain = value.partition("@")
        for shared in SHARED_DOMAINS:
            if domain == shared:
                return f"{self.spelled(local, 'mail@' + domain)}@{domain}"
            if domain.endswith("." + shared):
                rest = domain[: -len(shared) - 1]
                both = self.spelled(f"{local}@{rest}", "mail@" + shared)
                return f"{both}.{shared}"
        rest, _, top = domain.rpartition(".")
        return self.spelled(f"{local}@{rest}", "mail." + top) + "." + top

    def phone(self, value: str) -> str:
        """'+' and digits; the country code and the exchange 555 stay, area codes start with 2 to 9."""
        if value.startswith("+1") and len(value) == 12:
            head, area, mid, line = value[:-10], value[-10:-7], value[-7:-4], value[-4:]
            # Other exchanges are numbered without 555, which has surrogates of its own.
            exchange = int(mid) - (mid > "555")
            exchanges = 1 if mid == "555" else 999
            tail = (int(area[1:]) * exchanges + (0 if mid == "555" else exchange)) * 10**4 + int(line)
            size = 100 * exchanges * 10**4
            what = 4 if mid == "555" else 7
            if area[0] in "23456789":
                x = self.permuted((int(area[0]) - 2) * size + tail, 8 * size, f"tel:{head}:{what}")
                first, tail = divmod(x, size)
                area0 = str(first + 2)
            else:
                area0, tail = area[0], self.permuted(tail, size, f"tel:{head}{area[0]}:{what}")
            rest, line = divmod(tail, 10**4)
            rest, exchange = divmod(rest, exchanges)
            return head + area0 + "%02d%03d%04d" % (rest, 555 if mid == "555" else exchange + (exchange >= 555), line)
        keep = 2 if len(value) > 9 else 1
        return value[: keep + 1] + self.digits(value[keep + 1 :], "tel" + value[: keep + 1])

    def card(self, value: str) -> str:
        """The first digit stays; valid check digits stay valid, others invalid by as much as a permutation says."""
        body, check = value[1:-1], int(value[-1])
        wrong = (check - luhn(value[0] + body)) % 10
        n = len(body)
        if wrong == 0:
            body = self.digits(body, "card" + value[0])
            return value[0] + body + str(luhn(value[0] + body))
        x = self.permuted(int(body) * 9 + wrong - 1, 9 * 10**n, f"card-{value[0]}:{n}")
        body = "%0*d" % (n, x // 9)
        return value[0] + body + str((luhn(value[0] + body) + x % 9 + 1) % 10)

    def ip(self, value: str) -> str:
        """Private, loopback and multicast blocks keep their prefix; other addresses change as one number."""
        parts = [int(p) for p in value.split(".")]
        keep = 1 if parts[0] in (0, 10, 127) or parts[0] >= 224 else 2 if parts[:2] in ([192, 168], [169, 254]) or parts[0] == 172 and 16 <= parts[1] < 32 else 0
        if keep:
            x = 0
            for p in parts[keep:]:
                x = x * 256 + p
            x = self.permuted(x, 256 ** (4 - keep), "ip" + ".".join(map(str, parts[:keep])))
            return ".".join(map(str, parts[:keep] + [x >> 8 * i & 255 for i in reversed(range(4 - keep))]))
        public = [a for a in range(1, 224) if a not in (10, 127, 169, 172, 192)]
        if parts[0] not in public:  # 169, 172 and 192 hold both kinds
            pairs = [b for b in range(256) if not (parts[0] == 172 and 16 <= b < 32 or (parts[0], b) in ((192, 168), (169, 254)))]
            x = self.permuted(pairs.index(parts[1]) * 65536 + parts[2] * 256 + parts[3], len(pairs) * 65536, f"ip{parts[0]}")
            return f"{parts[0]}.{pairs[x >> 16]}.{x >> 8 & 255}.{x & 255}"
        x = self.permuted((public.index(parts[0]) << 24) + (parts[1] << 16) + (parts[2] << 8) + parts[3], len(public) << 24, "ip")
        return f"{public[x >> 24]}.{x >> 16 & 255}.{x >> 8 & 255}.{x & 255}"

    def ssn(self, value: str) -> str:
        return self.digits(value, "ssn")

    def iban(self, value: str) -> str:
        body = self.spelled(value[4:], "iban" + value[:2])
        return value[:2] + "%02d" % (98 - mod97(body + value[:2] + "00")) + body

    def given(self, value: str) -> str:
        kind, i = self.place[value]
        return self.names[kind][self.permuted(i, len(self.names[kind]), "given" + "".join(kind))]

    def family(self, value: str) -> str:
        """The name with another stem; both genders' endings go with the same stem."""
        for pair in GENDERED:
            for ending in pair:
                if value.endswith(ending) and len(value) >= len(ending) + 2:
                    return self.spelled(value[: -len(ending)], "family" + pair[0]) + ending
        out = self.spelled(value, "family")
        while any(out.endswith(e) for pair in GENDERED for e in pair):  # those are the surrogates of names that end so
            out = self.spelled(out, "family")
        return out

    def named(self, words: str) -> str:
        """A name's parts replaced, each by its own kind; initials change too, particles and white space stay."""
        parts = re.findall(r"\s+|\S+", words)
        return "".join(p if p.isspace() or p in PARTICLES else self.surrogate("given" if p in self.place else "family", p) for p in parts)

    def surrogate(self, kind: str, canonical: str) -> str:
        """Surrogate of a canonical form, remembered for repeated mentions."""
        found = self._memo.get((kind, canonical))
        if found is None:
            if len(self._memo) > 200_000:
                self._memo.clear()
            found = self._memo[kind, canonical] = getattr(self, kind)(canonical)
        return found

    def find(self, text: str) -> list[tuple[int, int, str, str, str, str]]:
        """(start, end, kind, canonical, replacement, whole), in order, without overlaps.

        whole is the canonical form of the entity that a mention belongs to: for a name alone the full name, if it is
        one person's in the text, else the canonical form itself.
        """
        found: list[tuple[int, int, str, str, str, str]] = []

        def add(span: tuple[int, int], kind: str, canonical: str, new: str, whole: str | None = None) -> None:
            found.append((*span, kind, canonical, new, whole or canonical))

        if "@" in text:
            for m in _EMAIL.finditer(text):
                canonical = m[0].lower()
                add(m.span(), "email", canonical, recased(m[0], self.surrogate("email", canonical)))
        for m in _NUMBER.finditer(text):
            kind = m.lastgroup
            canonical = m[0] if kind == "ip" else re.sub(r"[^\d+]", "", m[0])
            if kind == "phone" and not 8 <= len(canonical.lstrip("+")) <= 15:
                continue
            if kind == "ip":
                canonical = ".".join(str(int(p)) for p in m[0].split("."))
                add(m.span(), kind, canonical, self.surrogate(kind, canonical))
                continue
            national = kind == "phone" and canonical[0] != "+"
            canonical = "+1" + canonical if national else canonical  # ten digits are the number with country code 1
            new = self.surrogate(kind, canonical)
            add(m.span(), kind, canonical, refilled(m[0], new[2:] if national else new, r"\d"))
        for m in _IBAN.finditer(text):
            canonical = m[0].replace(" ", "")
            if 15 <= len(canonical) <= 34 and mod97(canonical[4:] + canonical[:4]) == 1:
                add(m.span(), "iban", canonical, refilled(m[0], self.surrogate("iban", canonical), "[A-Z0-9]"))
        owners: dict[str, set[str]] = {}
        for m in self.person.finditer(text):
            whole = " ".join([m[1], *m[2].split()])
            if any(p not in PARTICLES and not p[0].isupper() for p in whole.split()):
                continue
            for part in whole.split():
                if len(part.rstrip(".")) > 1 and part not in PARTICLES:
                    owners.setdefault(part, set()).add(whole)
            add(m.span(), "person", whole, self.named(m[0]))
        if owners:  # later or earlier mentions by given or family name alone
            alone = re.compile(r"(?<!\w)(?:" + "|".join(sorted(map(re.escape, owners), key=len, reverse=True)) + r")(?!\w)")
            nouns = None
            for m in alone.finditer(text):
                if m[0] not in self.place:
                    nouns = writes_nouns_large(text) if nouns is None else nouns
                    before = text[max(0, m.start() - 24) : m.start()]
                    if nouns and not (_TITLED.search(before) or text[m.end() : m.end() + 2] in ("'s", "’s")):
                        continue  # may be a noun
                add(m.span(), "person", m[0], self.named(m[0]), next(iter(owners[m[0]])) if len(owners[m[0]]) == 1 else None)
        out: list[tuple[int, int, str, str, str, str]] = []
        for x in sorted(found, key=lambda x: (x[0], -x[1])):
            if not out or x[0] >= out[-1][1]:
                out.append(x)
        return out

    def replaced(self, text: str) -> tuple[str, list[tuple[int, int, str, str, str, str]]]:
        """The text with its entities replaced, and the entities."""
        found = self.find(text)
        if not found:
            return text, found
        out, at = [], 0
        for start, end, _, _, new, _ in found:
            out += [text[at:start], new]
            at = end
        return "".join([*out, text[at:]]), found


def luhn(digits: str) -> int:
    """Check digit of a card number without it."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def recased(old: str, new: str) -> str:
    """The new text with the upper case of the old one, of equal length."""
    return "".join(b.upper() if a.isupper() else b for a, b in zip(old, new)) if len(old) == len(new) else new


def refilled(old: str, new: str, what: str) -> str:
    """The old format with its characters of a kind replaced in order."""
    fresh = iter(re.findall(what, new))
    return re.sub(what, lambda _: next(fresh), old)


def replace_pii(df: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", given: dict = GIVEN) -> DataFrame:
    """Each whole text with its personal data replaced.

    Found: mail addresses, phone numbers, card numbers, IPv4 addresses, US social security numbers, IBANs
    with right check digits, and persons (a listed given name followed by family names, and each of these names
    alone elsewhere in the same text; where nouns are written large, a family name alone only after a title or initial,
    or before 's). Different forms of one entity (case, spacing, punctuation, a phone number without country code 1) share a
    surrogate. Of overlapping entities the first counts, of those with one start the longest.

    Returns id_col, text_col, entities array<struct<start int, end int, kind string, entity string, surrogate
    string, whole string>>: places in the original text, a keyed digest of the canonical form, the replacement, and the
    digest of the entity that the mention belongs to (a name alone belongs to the full name); one row for each input row. Null stays null and empty stays empty, without entities. Other columns are
    left out. No shuffle.
    """
    item = T.StructType(
        [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("entity", T.StringType()), T.StructField("surrogate", T.StringType()), T.StructField("whole", T.StringType())]
    )
    schema = T.StructType([df.schema[id_col], T.StructField(text_col, T.StringType()), T.StructField("entities", T.ArrayType(item))])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        worker = Surrogates(key, given)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("entity", pa.string()), ("surrogate", pa.string()), ("whole", pa.string())]))

        def digest(what: str, value: str) -> str:
            return blake2b(f"{what}:{value}".encode(), key=key, digest_size=16).hexdigest()

        for batch in batches:
            texts, entities = [], []
            for text in batch.column(1):
                text = text.as_py()
                new, found = worker.replaced(text) if text else (text, [])
                texts.append(new)
                entities.append([{"start": a, "end": b, "kind": k, "entity": digest(k, c), "surrogate": s, "whole": digest(k, w)} for a, b, k, c, s, w in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(entities, kind)], names=[id_col, text_col, "entities"])

    return arrow_map(df.select(id_col, text_col), run, schema)


def collisions(replaced: DataFrame) -> DataFrame:
    """Surrogates that more than one entity got (kind, surrogate, entities); empty if all went well.

    Surrogates count without what their forms differ in: marks and the country code 1 in numbers, case in mail addresses,
    white space in names.
    """
    seen = replaced.select(F.explode("entities").alias("e")).select("e.kind", "e.entity", "e.surrogate")
    plain = (
        F.when(F.col("kind").isin("phone", "card", "ssn"), F.regexp_replace(F.regexp_replace("surrogate", r"[^0-9+]", ""), r"^\+1(?=[0-9]{10}$)", ""))
        .when(F.col("kind") == "email", F.lower("surrogate"))
        .when(F.col("kind") == "iban", F.replace("surrogate", F.lit(" "), F.lit("")))
        .otherwise(F.regexp_replace("surrogate", r"[\s\u00a0]+", " "))
    )
    seen = seen.select("kind", "entity", plain.alias("surrogate"))
    return seen.distinct().groupBy("kind", "surrogate").agg(F.count("*").alias("entities")).where("entities > 1")


def replace_checked(df: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", given: dict = GIVEN, tries: int = 4) -> DataFrame:
    """:func:`replace_pii` under the key, or under the next one derived from it if two entities got one surrogate.

    The result is written before it is checked. Raises if no key of so many gives distinct surrogates.
    """
    for attempt in range(tries):
        used = blake2b(b"%d" % attempt, key=key[:64]).digest() if attempt else key
        made = materialize(replace_pii(df, used, id_col, text_col, given), "pii")
        if not collisions(made).limit(1).count():
            return made
        drop(made)
    raise RuntimeError(f"two entities share a surrogate under each of {tries} keys")
