"""Secret scan: candidate strings in texts, with false positives removed by a random forest.

Candidates, their features and the forest's votes are DataFrame expressions. The forest is trained from a
bounded table of labelled findings and compiled to one CASE expression for each tree.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize

#: Shortest candidate. Shorter secrets are not looked for.
LEAST = 16
#: A key's line of 64 or 76 characters, the break behind it, and the next line: wrapped keys are read as one run.
WRAPPED = r"(?<=[A-Za-z0-9+/]{64})\r?\n(?=[A-Za-z0-9+/]{4,76}={0,2}(?:\s|$))"
RUN = "[A-Za-z0-9+/_-]"
#: Words that make a string less likely a secret, for dictionary coverage.
DICTIONARY = (
    "about account admin after again alpha and api app archive array asset author auto backup base beta black block board body book branch "
    "build button cache change char check class client clock cloud code color column commit common config connect content control copy core "
    "count create current custom data date debug default delete demo deploy design detail device digest document domain driver dummy east "
    "edit email empty engine entry error event example export factory false field file filter final first font form format frame front "
    "function game general global green group handle hash head header height hello help home host html http icon image import index info "
    "input insert install item java javascript label language large last layout left level library light line link list load local lock "
    "login logo long main manager map mark market master media member menu message method mobile model module month name network new next "
    "node none north note null number object office online open option order output package page panel parent path photo place placeholder "
    "plain player plugin point post print private process product profile program project public query random read record release remote "
    "report request reset resource result return right root row sample save script search secret section select server service session set "
    "setup shared simple site size small source south space stack start state static status store stream string style summary support "
    "switch system table target task team template test text theme time title token tool total track tree true type unit update upload url "
    "user util value version video view web west white widget width window with word work world write xxxx your"
).split()
SECRET_WORDS = "password|passwd|pwd|secret|token|api[_-]?key|apikey|access[_-]?key|auth|credential|private|bearer|client[_-]?key|key"
PLAIN_WORDS = "commit|sha1|sha256|sha|md5|checksum|hash|digest|revision|rev|uuid|guid|version|build|etag|card|account|order|invoice|isbn|phone|trace|id|blob|integrity|image|file|path|href|src"
FEATURES = (
    "length", "digits", "uppers", "lowers", "vowels", "changes", "distinct", "letters_run", "digits_run", "consonants_run", "coverage", "hex_only", "marked", "in_path",
    "secret_near", "plain_near", "assigned", "quoted",
)


def candidates(df: DataFrame, id_col: str, text_col: str, context: tuple[str, ...] = ()) -> DataFrame:
    """(id, place, value, prefix, before, after) of every run of 16 or more token characters in a word.

    place counts words from 0, a wrapped key as one; a word can have several runs. before holds the two words before, after the rest of the word
    and the one behind. prefix is what leads to the run within its part of the word (a field, a parameter, a list's item).
    """
    words = df.select(F.col(id_col).alias("id"), *context, F.split(F.regexp_replace(F.col(text_col), WRAPPED, ""), r"\s+").alias("words"))
    at = lambda i: F.get("words", i)
    fits = lambda i: (F.length(at(i)) >= LEAST) & at(i).rlike(f"{RUN}{{{LEAST},}}")
    found = words.select(
        "id", *context,
        F.explode(
            F.transform(
                F.filter(F.sequence(F.lit(0), F.size("words") - 1), fits),
                lambda i: F.struct(
                    i.alias("place"), at(i).alias("word"), F.concat_ws(" ", at(i - 2), at(i - 1)).alias("before"), F.coalesce(at(i + 1), F.lit("")).alias("after")
                ),
            )
        ).alias("c"),
    )
    # Each match is a gap and the run behind it; = belongs to the run only as padding.
    pattern = rf"(?s)(.*?)({RUN}{{{LEAST},}}(?:=+(?![A-Za-z0-9+/_=-]))?)"
    every = lambda group: F.regexp_extract_all("c.word", F.lit(pattern), F.lit(group))
    rest = F.regexp_replace("c.word", pattern, "")
    runs = found.select("id", *context, "c.place", "c.before", "c.after", every(1).alias("gaps"), every(2).alias("runs"), rest.alias("rest"))
    one = lambda value, i: F.struct(
        value.alias("value"),
        F.regexp_extract(F.concat(F.when(i > 0, F.get("runs", i - 1)).otherwise(""), F.get("gaps", i)), r"[^?&,;|(){}\[\]]*$", 0).alias("prefix"),
        F.concat_ws(" ", F.coalesce(F.get("gaps", i + 1), "rest"), "after").alias("after"),
    )
    parts = runs.select("id", *context, "place", "before", F.explode(F.transform("runs", one)).alias("r"))
    return parts.select("id", *context, "place", "r.value", "r.prefix", "before", "r.after")


def features(found: DataFrame) -> DataFrame:
    """found with a double column for each of FEATURES."""
    v, n = F.col("value"), F.greatest(F.length("value"), F.lit(1)).cast("double")
    share = lambda pattern: F.regexp_count(v, F.lit(pattern)) / n
    near = F.lower(F.concat_ws(" ", F.col("before"), F.col("prefix")))
    longest = lambda pattern: F.coalesce(F.array_max(F.transform(F.regexp_extract_all(v, F.lit(f"({pattern})"), F.lit(1)), F.length)), F.lit(0))
    covered = F.length(F.regexp_replace(F.lower(v), "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w))), ""))
    columns = {
        "length": F.least(n, F.lit(100.0)),
        "digits": share("[0-9]"),
        "uppers": share("[A-Z]"),
        "lowers": share("[a-z]"),
        "vowels": F.regexp_count(v, F.lit("[AEIOUaeiou]")) / F.greatest(F.regexp_count(v, F.lit("[A-Za-z]")), F.lit(1)),
        # Changes between digits, upper and lower case and marks, per character.
        "changes": F.regexp_count(v, F.lit(r"(?<=[0-9])(?![0-9]|$)|(?<=[A-Z])(?![A-Z]|$)|(?<=[a-z])(?![a-z]|$)|(?<=[+/_=-])(?![+/_=-]|$)")) / n,
        "distinct": F.size(F.array_distinct(F.split(v, ""))) / F.least(n, F.lit(40.0)),
        "letters_run": longest("[A-Za-z]+"),
        "digits_run": longest("[0-9]+"),
        "consonants_run": longest("[B-DF-HJ-NP-TV-XZb-df-hj-np-tv-xz]+"),
        "coverage": (n - covered) / n,
        "hex_only": v.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"),
        "marked": v.rlike("^(?:AKIA|ASIA|ghp_|gho_|github_pat_|sk-|sk_live_|rk_live_|xox[abp]-|glpat-|AIza|eyJ)"),
        "in_path": F.col("prefix").rlike("[/\\\\]|://") | v.rlike("/.*/"),
        "secret_near": near.rlike(rf"(?:^|[^a-z])(?:[a-z_-]*(?:{SECRET_WORDS}))[\"' ]*[=:>]*[\"' ]*$|(?:{SECRET_WORDS})[^a-z]* (?:is|[=:]+)|private key----- ?$"),
        "plain_near": near.rlike(rf"(?:^|[^a-z])(?:{PLAIN_WORDS})(?:[^a-z]|$)"),
        "assigned": F.col("prefix").rlike("[=:][\"']?$") | F.col("before").rlike("(?:^|[^A-Za-z0-9])[=:]+$|[A-Za-z_\"'][=:]+$"),
        "quoted": F.col("prefix").rlike("[\"'`]$"),
    }
    return found.withColumns({k: columns[k].cast("double") for k in FEATURES})


@dataclass(frozen=True)
class Node:
    """A split (feature, bound, below, above) or a leaf (share of secrets)."""

    share: float
    feature: int = -1
    bound: float = 0.0
    below: Node | None = None
    above: Node | None = None

    def column(self) -> Column:
        if self.below is None:
            return F.lit(round(self.share, 6))
        return F.when(F.col(FEATURES[self.feature]) <= F.lit(self.bound), self.below.column()).otherwise(self.above.column())


def grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int, least: int = 4) -> Node:
    """A tree by Gini impurity; each split looks at a random half of the features."""
    share = float(y.mean())
    if depth == 0 or len(y) < 2 * least or share in (0.0, 1.0):
        return Node(share)
    best = (share * (1 - share) * len(y) - 1e-9, -1, 0.0)
    for f in rng.permutation(x.shape[1])[: max(3, x.shape[1] // 2)]:
        order = np.argsort(x[:, f], kind="stable")
        values, ones = x[order, f], np.cumsum(y[order])
        cut = np.nonzero(values[1:] > values[:-1])[0]
        cut = cut[(cut + 1 >= least) & (len(y) - cut - 1 >= least)]
        if not len(cut):
            continue
        n, k = cut + 1.0, ones[cut]
        m, j = len(y) - n, ones[-1] - k
        impurity = k * (1 - k / n) + j * (1 - j / m)
        at = int(np.argmin(impurity))
        if impurity[at] < best[0]:
            best = (float(impurity[at]), int(f), float((values[cut[at]] + values[cut[at] + 1]) / 2))
    if best[1] < 0:
        return Node(share)
    low = x[:, best[1]] <= best[2]
    return Node(share, best[1], best[2], grow(x[low], y[low], rng, depth - 1, least), grow(x[~low], y[~low], rng, depth - 1, least))


def walked(tree: Node, row) -> float:
    """The share of the leaf that a row of features ends in; what :meth:`Node.column` compiles."""
    while tree.below is not None:
        tree = tree.below if row[tree.feature] <= tree.bound else tree.above
    return round(tree.share, 6)


def train(findings: DataFrame, trees: int = 16, depth: int = 9, rows: int = 10_000, seed: int = 5) -> list[Node]:
    """Forest from labelled findings: value, prefix, before, after, label (0 or 1).

    At most `rows` findings are used, the first by a hash of the value. The driver holds only these.
    """
    used = findings.where("label is not null").orderBy(F.xxhash64("value"), "value", "before").limit(rows)
    data = np.array([tuple(r) for r in features(used).select(*FEATURES, "label").collect()], dtype=float)
    if not len(data):
        return [Node(0.0)]
    rng, out = np.random.default_rng(seed), []
    for _ in range(trees):
        pick = rng.integers(len(data), size=len(data))
        out.append(grow(data[pick, :-1], data[pick, -1], rng, depth))
    return out


def labelled_findings(spark: SparkSession, rows: int = 9000, seed: str = "finding") -> DataFrame:
    """Labelled findings made by rule: a value of one of many kinds in one of many surroundings, drawn apart.

    A random value is a secret where a secret's name assigns it, and everywhere if it has a service's mark; words, numbers,
    dates, paths, placeholders and digests are none. Production passes its own findings.
    """
    number = lambda salt, n: F.pmod(F.xxhash64("h", F.lit(salt)), F.lit(n)).cast("int")
    pick = lambda items, salt: F.element_at(F.array(*[F.lit(x) if isinstance(x, str) else x for x in items]), number(salt, len(items)) + 1)
    n = number("length", 45) + 16
    first = lambda text, size: F.substring(text, F.lit(1), size)
    joined = lambda mark, size, salt: F.concat_ws(mark, *[pick(DICTIONARY, f"{salt}{i}") for i in range(size)])
    syllable = lambda i: F.concat(
        pick("b br ch d dr f fl g gr h k kl l m n p pr qu r s sch sp st t th tr v w z".split(), f"onset{i}"), pick("a e i o u ei ie au ou ea".split(), f"vowel{i}"),
        pick(["", "", "", "n", "r", "s", "t", "ng", "nd", "rt", "st", "cht", "mpf"], f"coda{i}"),
    )
    hexa, b64, b62, digits, word, name, other, talk, quote = map(F.col, ("hexa", "b64", "b62", "digits", "word", "name", "other", "talk", "quote"))
    marks = "AKIA ASIA ghp_ gho_ github_pat_ sk- sk_live_ rk_live_ xoxb- xoxp- glpat- AIza eyJ".split()
    values = {  # 1: random, 2: random with a mark, 0: neither
        "hex": (1, first(hexa, n)), "HEX": (1, F.upper(first(hexa, n))), "base64": (1, F.substring(b64, 1, 40)), "padded": (1, F.concat(F.substring(b64, 1, 43), F.lit("="))),
        "wrapped": (1, F.concat(b64, F.substring(F.reverse(b64), 2, 100))), "base62": (1, first(b62, n)), "url": (1, first(F.translate(b64, "+/=", "-_"), n)),
        "letters": (1, first(F.translate(b62, "0123456789", "qXzKvJpTyw"), n)), "lower": (1, first(F.lower(F.translate(b62, "0123456789", "qxzkvjptyw")), n)),
        "upper": (1, first(F.upper(b62), n)), "small": (1, first(F.lower(b62), n)), "prefixed": (1, F.concat(first(F.lower(b62), number("prefix", 3) + 2), pick(["_", "-"], "mark"), F.substring(F.reverse(b62), F.lit(1), n))),
        "marked": (2, F.concat(pick(marks, "service"), F.substring(F.reverse(b62), F.lit(4), n))), "MARKED": (2, F.concat(pick(["AKIA", "ASIA"], "cloud"), F.upper(F.translate(F.substring("g", 1, 16), "01", "yz")))),
        "snake": (0, joined("_", 4, "s")), "kebab": (0, F.concat(joined("-", 4, "k"), F.lit("-"), F.substring(digits, 1, 4))), "path": (0, F.concat(joined("/", 4, "p"), F.lit("/"), F.substring("h", 1, 8))),
        "camel": (0, F.replace(F.initcap(joined(" ", 4, "c")), F.lit(" "), F.lit(""))), "compound": (0, joined("", 4, "w")), "word": (0, word), "Word": (0, F.initcap(word)), "WORD": (0, F.upper(word)),
        "digits": (0, first(digits, number("digits", 9) + 16)), "uuid": (0, F.concat_ws("-", *[F.substring("h", p, k) for p, k in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])),
        "date": (0, F.concat(F.lit("20"), F.substring(digits, 1, 2), F.lit("-0"), F.substring(digits, 3, 1), F.lit("-1"), F.substring(digits, 4, 1), F.lit("T10-2"), F.substring(digits, 5, 1), F.lit("-30"))),
        "holder": (0, F.concat(F.lit("your_"), joined("_", 2, "h"), F.lit("_here"))), "same": (0, F.repeat(F.substring("h", 1, 1), 24)), "stars": (0, F.concat(F.repeat(F.lit("x"), 20), F.substring("h", 1, 2))),
    }
    around = []  # (whether a secret's name assigns the value, prefix, before)
    for mine, what in ((1, name), (0, other)):
        around += [
            (mine, F.concat(what, pick(["=", ":", "=", ":="], "sign"), quote), talk), (mine, quote, F.concat(what, pick([" =", ":", " :", " = "], "sign"))),
            (mine, F.concat(F.lit('"'), what, F.lit('":"')), talk), (mine, F.concat(what, F.lit("=")), talk), (mine, F.concat(F.lit("--"), what, F.lit("=")), talk),
            (mine, F.concat(F.lit("<"), what, F.lit(">")), talk), (mine, F.concat(pick(["?", "&", "."], "field"), what, F.lit("=")), talk),
        ]
    around += [(1, F.lit(""), F.concat(F.lit("Authorization: "), pick(["Bearer", "bearer", "token"], "scheme"))), *[(1, F.lit(""), F.lit("PRIVATE KEY-----"))] * 2]
    around += [(0, F.lit(""), talk)] * 5 + [(0, pick(['"', "(", "https://example.org/", "/usr/lib/", "-"], "lead"), talk), (0, F.lit(""), F.concat(pick(DICTIONARY, "t4"), F.lit(" "), other))]
    value = F.array(*[F.struct(F.lit(kind).alias("kind"), v.alias("value")) for kind, v in values.values()])
    place = F.array(*[F.struct(F.lit(mine).alias("mine"), p.alias("prefix"), b.alias("before")) for mine, p, b in around])
    # Layer by layer, so that no expression is spelled out within another again and again.
    owned = F.concat(pick(["", "", "db_", "MY_", "aws_", "x-", "client_"], "own"), pick("password passwd pwd secret token api_key apikey access_key auth credential private_key bearer secret_key".split(), "name"))
    layers = [
        {"h": F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)},
        {"g": F.sha2("h", 512)},
        {"hexa": F.concat("h", "g"), "digits": F.translate("g", "abcdef", "012345")},
        {"b64": F.regexp_replace(F.base64(F.unhex("hexa")), "[\r\n]", "")},
        {"b62": F.translate("b64", "+/=", "aB")},
        {
            "word": F.concat(*[syllable(i) for i in range(6)], F.when(number("long", 2) == 0, F.concat(*[syllable(i) for i in range(6, 9)])).otherwise("")),
            "name": F.when(number("case", 4) == 0, F.upper(owned)).otherwise(owned),
            "other": pick("name title label color file image path href commit sha256 md5 checksum revision digest etag hash build blob integrity uuid id version order card phone page user".split(), "other"),
            "talk": F.concat(pick(DICTIONARY, "t1"), F.lit(" "), pick(["and", "the", "und", "with", "les", "que", "of"], "t2")),
            "quote": pick(['"', "'", ""], "quote"),
        },
        {"v": F.element_at(value, number("value", len(values)) + 1), "p": F.element_at(place, number("place", len(around)) + 1)},
    ]
    drawn = spark.range(rows)
    for layer in layers:
        drawn = drawn.withColumns(layer)
    label = ((F.col("v.kind") == 2) | (F.col("v.kind") == 1) & (F.col("p.mine") == 1)).cast("int")
    drawn = materialize(drawn.select("v.value", "p.prefix", "p.before", F.lit("").alias("after"), label.alias("label")), "findings")
    return drawn.where(F.length("value") >= LEAST)


def scan(df: DataFrame, forest: list[Node], id_col: str = "doc_id", text_col: str = "text", at: float = 0.5) -> DataFrame:
    """Findings that the forest keeps, in whole texts.

    Returns id_col, place int (word of the text, from 0), kind string (known format, or generic), masked string
    (the first four characters and the length), value_sha256, score double; one row for each occurrence, so repeated
    rows repeat. Null and empty texts and empty tables have no findings. No shuffle; candidates are written once.
    """
    votes = sum((t.column() for t in forest[1:]), forest[0].column()) / F.lit(float(len(forest)))
    # Written, as the filter on the votes would spell out every feature again at each split of a tree.
    rows = materialize(features(candidates(df, id_col, text_col)), "candidates")
    rows = rows.withColumn("score", F.round(votes, 6)).where(F.col("score") >= at)
    v = F.col("value")
    kind = (
        F.when(v.rlike("^(?:AKIA|ASIA)[A-Z0-9]{16}$"), "cloud access key").when(v.rlike("^(?:ghp_|gho_|github_pat_|glpat-)"), "repository token")
        .when(v.rlike("^(?:sk-|sk_live_|rk_live_|xox[abp]-|AIza)"), "service key").when(v.rlike("^eyJ"), "web token").otherwise("generic")
    )
    return rows.select(
        F.col("id").alias(id_col), F.col("place").cast("int").alias("place"), kind.alias("kind"),
        F.concat(F.substring(v, 1, 4), F.lit("…"), F.length(v).cast("string")).alias("masked"), F.sha2(v, 256).alias("value_sha256"), "score",
    )
