"""Toxicity scores from a support vector machine on a gapped subsequence kernel with Nyström landmarks.

The kernel compares words by their subsequences of three, five and seven characters, each weighted by decay
to the power of the characters it skips, so inserted and left-out characters cost little. Words are mapped to the
landmarks' space and classified by a linear machine with squared hinge loss. Labels are given for texts,
not for words: the machine is trained in rounds, on the words that look worst in toxic texts against the
words of clean ones (first by their counts, then by the machine's own margins). A text's score is a
logistic function of its two worst words, fitted on texts that the machine has not seen.

Landmarks and machine fold into one weight for each subsequence, so a word costs some table look-ups.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from heapq import nlargest

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map

#: Classes of characters: letters a to z, digits, 90 classes for all others by code point, and a word's edge.
ALPHABET, OTHERS = 128, 90
EDGE = ALPHABET - 1
DECAY = 0.6
#: Slots of the table of subsequences (they share slots by hash).
SLOTS = 1 << 17
#: Places of a subsequence's characters after the first, and its weight.
STEPS = tuple(((a, b), DECAY ** (b - 2)) for b in (2, 3, 4) for a in range(1, b)) + tuple(
    (tuple(i + (skip > 0 and i >= skip) for i in range(1, n)), DECAY ** (skip > 0)) for n in (5, 7) for skip in range(n)
)
PIECE = 24  # longer words are taken in overlapping pieces
#: Texts of each label that the machine learns from, at most.
SAMPLE = 1500
LANDMARKS = 240
FLOOR = -3.0
_SPELLED = re.compile(r"(?<!\S)(?:\S ){2,}\S(?!\S)")
_STRIP = ".,;:!?\"'()[]{}<>«»„“”‘’…"


def words_of(text: str | None) -> set[str]:
    """Distinct words of a text, lower-cased; letters set apart by single spaces also count as one word."""
    if not text:
        return set()
    text = text.lower()
    found = set(text.split())
    for m in _SPELLED.finditer(text):
        found.add(m[0].replace(" ", ""))
    return found


def _class_of(code: int) -> int:
    base = chr(code).lower()[0]
    if "a" <= base <= "z":
        return ord(base) - 96
    return 27 + int(base) if "0" <= base <= "9" else 37 + code % OTHERS


#: Classes of the characters below U+0250; others go by their code alone.
_CLASSES = np.array([0, *map(_class_of, range(1, 0x250))], dtype=np.int32)


def _ids(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Character classes of the words' pieces (0: none), and the word of each piece."""
    pieces, owner = [], []
    for i, w in enumerate(words):
        for at in range(0, max(1, len(w) - 4), PIECE - 4):
            pieces.append(w[at : at + PIECE])
            owner.append(i)
    wide = np.array(pieces or [""], dtype=f"U{PIECE}")
    codes = wide.view(np.uint32).reshape(len(wide), PIECE).astype(np.int32)[: len(pieces)]
    ids = np.where(codes < len(_CLASSES), _CLASSES[np.minimum(codes, len(_CLASSES) - 1)], 37 + codes % OTHERS)
    return np.concatenate([np.full((len(ids), 1), EDGE), ids], axis=1), np.array(owner, dtype=np.int64)


def _features(ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(slots, weights) of subsequences; a weight is 0 where the word has ended."""
    ids = ids[:, : max(5, int((ids > 0).sum(axis=1).max(initial=0)))].astype(np.int64)
    for places, weight in STEPS:
        n = ids.shape[1] - places[-1]
        if n <= 0:
            continue
        codes = ids[:, :n]
        for p in places:
            codes = codes * ALPHABET + ids[:, p : p + n]
        slots = ((codes * 2654435761 ^ codes >> 17) >> 20) % SLOTS
        yield slots, (ids[:, places[-1] : places[-1] + n] > 0) * np.float32(weight)


def _norms(ids: np.ndarray) -> np.ndarray:
    """Length of each piece, every occurrence of a subsequence counted apart."""
    return np.sqrt(sum((w * w).sum(axis=1) for _, w in _features(ids)) + 1e-6)


def dot(ids: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Normalized pieces times one weight by subsequence."""
    return sum((weights[codes] * w).sum(axis=1) for codes, w in _features(ids)) / _norms(ids)


def kernel(ids: np.ndarray, used: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Normalized pieces against landmarks' profiles, which are given on the slots they use."""
    place = np.full(SLOTS, len(used))
    place[used] = np.arange(len(used))
    right = np.concatenate([base.T, np.zeros((1, len(base)), dtype=np.float32)])
    order, out = np.argsort((ids > 0).sum(axis=1), kind="stable"), np.zeros((len(ids), len(base)), dtype=np.float32)
    for at in range(0, len(ids), 256):
        part = order[at : at + 256]
        for slots, w in _features(ids[part]):
            out[part] += np.einsum("wp,wpl->wl", w, right[place[slots]])
        out[part] /= _norms(ids[part])[:, None]
    return out


def landmarks_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slots that the landmarks use, normalized profiles on them)."""
    used = np.unique(np.concatenate([slots[w > 0] for slots, w in _features(ids)]))
    out = np.zeros((len(ids), len(used)), dtype=np.float32)
    for slots, w in _features(ids):
        row, col = np.nonzero(w)
        np.add.at(out, (row, np.searchsorted(used, slots[row, col])), w[row, col])
    return used, out / _norms(ids)[:, None]


def profile(ids: np.ndarray) -> np.ndarray:
    """Normalized feature vector of one piece, on all slots."""
    out = np.zeros(SLOTS, dtype=np.float32)
    for slots, w in _features(ids):
        np.add.at(out, slots, w)
    return out / _norms(ids)[0]


@dataclass
class Model:
    """Weight of each subsequence, bias, and the logistic function's coefficients."""

    weights: np.ndarray | None = None
    bias: float = 0.0
    logistic: np.ndarray = field(default_factory=lambda: np.zeros(3))
    prior: float = 0.0

    def margins(self, words: list[str]) -> np.ndarray:
        """Margin of each word: that of its worst piece."""
        out = np.full(len(words), FLOOR)
        if self.weights is None:
            return out
        # Words of like length together, some at a time: little padding, little memory.
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for at in range(0, len(order), 4000):
            part = order[at : at + 4000]
            forms, owner = [], []
            for i in part:
                w = words[i].strip(_STRIP)
                forms.append(w)
                owner.append(i)
                if not w.isalnum() and (bare := "".join(c for c in w if c.isalnum())):
                    forms.append(bare)  # a word also counts without the marks between its letters
                    owner.append(i)
            ids, piece_of = _ids(forms)
            np.maximum.at(out, np.array(owner)[piece_of], np.clip(dot(ids, self.weights) + self.bias, FLOOR, -FLOOR))
        return out

    def probability(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(features), self.prior)
        return 1 / (1 + np.exp(-np.clip(features @ self.logistic[:2] + self.logistic[2], -30, 30)))


def text_features(margins: list[float]) -> tuple[float, float]:
    """Worst margin and second worst."""
    top = nlargest(2, margins) + [FLOOR, FLOOR]
    return top[0], top[1]


def _machine(x: np.ndarray, y: np.ndarray, sample_weight: np.ndarray, c: float = 100.0) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by Newton steps."""
    xb = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(xb.shape[1]), np.eye(xb.shape[1])
    ridge[-1, -1] = 1e-6
    c = c / sample_weight.mean()

    def loss(w: np.ndarray) -> float:
        return float(w @ ridge @ w + 2 * c * (sample_weight * np.maximum(0, 1 - y * (xb @ w)) ** 2).sum())

    best = loss(w)
    for _ in range(50):
        active = y * (xb @ w) < 1
        xa, sa = xb[active], sample_weight[active]
        step = np.linalg.solve(ridge + 2 * c * (xa * sa[:, None]).T @ xa, 2 * c * (xa * sa[:, None]).T @ y[active]) - w
        size, now = 1.0, loss(w + step)
        while now > best and size > 1e-4:
            size /= 2
            now = loss(w + size * step)
        if best - now < 1e-9 * max(1.0, best):
            break
        w, best = w + size * step, now
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    xb = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(xb.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(xb @ w, -30, 30)))
        step = np.linalg.solve(xb.T @ (xb * (p * (1 - p))[:, None]) + 0.05 * np.eye(len(w)), xb.T @ (y - p) - 0.05 * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


@lru_cache(maxsize=20_000)
def _grams(word: str) -> frozenset[str]:
    """Beginnings and ends of 3 to 8 characters of a word, its edges marked."""
    word = word.strip(_STRIP)[:PIECE]
    return frozenset({"^" + word[:n] for n in range(3, 9)} | {word[-n:] + "$" for n in range(3, 9)})


def _telling(bad: list[list[str]], good: list[list[str]]) -> dict[str, float]:
    """Beginnings and ends of words that tell toxic texts: in 3 of them or more, and at least 25 times as likely as in clean ones."""
    in_bad, in_good = Counter(), Counter()
    for count, texts in ((in_bad, bad), (in_good, good)):
        if count is in_good:  # only what may tell is worth counting in clean texts
            for g in [g for g, n in in_bad.items() if n < 3]:
                del in_bad[g]
        for ws in texts:
            seen: set[str] = set()
            for w in ws:
                seen |= _grams(w)
            count.update(seen if count is in_bad else seen & in_bad.keys())
    out = {}
    for g, p in in_bad.items():
        if p < 3:
            continue
        rate, clean = p / len(bad), (in_good[g] + 0.5) / (len(good) + 1)
        if rate >= 25 * clean or in_good[g] == 0 and p * len(good) >= 12 * len(bad):
            out[g] = p * float(np.log(rate / clean))
    return out


def _varied(word: str, rng: np.random.Generator) -> list[str]:
    """The word as evaders write it: with a mark between letters, with a character put in, with a letter doubled."""
    at = 1 + int(rng.integers(max(1, len(word) - 1)))
    mark = ".-*_"[int(rng.integers(4))]
    letter = "abcdefghijklmnopqrstuvwxyz"[int(rng.integers(26))]
    return [word[:at] + mark + word[at:], word[:at] + letter + word[at:], word[:at] + word[at - 1] + word[at:]]


def fit(texts: list[tuple[list[str], int]], rounds: int = 2, landmarks: int = LANDMARKS, seed: int = 7) -> Model:
    """Machine from labelled texts given as (distinct words, label). Without both labels, a constant score.

    The machine learns from three quarters of the texts, the logistic function from the other quarter.
    """
    rng = np.random.default_rng(seed)
    own = [t for i, t in enumerate(texts) if i % 4] if len(texts) >= 40 else texts
    rest = [t for i, t in enumerate(texts) if i % 4 == 0] if len(texts) >= 40 else texts
    bad, good = [w for w, y in own if y], [w for w, y in own if not y]
    if not bad or not good:
        return Model(prior=float(np.mean([y for _, y in texts])) if texts else 0.0)
    telling = _telling(bad, good)
    _grams.cache_clear()
    in_bad, in_good = Counter(w for ws in bad for w in ws), Counter(w for ws in good for w in ws)
    memo: dict[str, float] = {}

    def first(w: str) -> float:
        if w not in memo:
            memo[w] = max((telling.get(g, 0.0) for g in _grams(w)), default=0.0)
        return memo[w]

    usual = [w for w, _ in sorted(in_good.items(), key=lambda x: (-x[1], x[0]))]
    usual = usual[:1000] + [usual[i] for i in sorted(rng.permutation(np.arange(min(1000, len(usual)), len(usual)))[:1800])]
    worst: Counter = Counter()
    for ws in bad:
        top = max((first(w) for w in ws), default=0.0)
        worst.update(w for w in ws if top and first(w) >= 0.25 * top)
    yes = [w for w in worst if in_good[w] * len(bad) <= 0.1 * in_bad[w] * len(good)]
    yes = sorted(sorted(yes, key=lambda w: (-worst[w], w))[:600])
    model, hard, margin = Model(), [], {}
    for _ in range(rounds):
        no = sorted({*usual, *hard} - set(yes))
        if not yes or not no:
            return Model(prior=len(bad) / len(own))
        forms = [f for w in yes for f in (w, *_varied(w.strip(_STRIP) or w, rng))]
        ids_yes, ids_no = (_ids([w.strip(_STRIP)[:PIECE] for w in ws])[0] for ws in (forms, no))
        half = landmarks // 2
        near = [i for i, w in enumerate(no) if w in set(hard)] or list(range(len(no)))
        pick = np.concatenate([_spread(ids_yes[::4], half, rng), _spread(ids_no[near], half, rng)])
        used, base = landmarks_of(pick)
        values, vectors = np.linalg.eigh((base @ base.T).astype(np.float64) + 1e-4 * np.eye(len(base)))
        root = vectors @ np.diag(np.maximum(values, 1e-4) ** -0.5) @ vectors.T
        x = np.concatenate([kernel(ids_yes, used, base), kernel(ids_no, used, base)]) @ root
        y = np.concatenate([np.ones(len(ids_yes)), -np.ones(len(ids_no))])
        many = np.repeat([np.sqrt(worst[w]) for w in yes], 4)
        weight = np.concatenate([many * len(ids_no) / many.sum(), np.ones(len(ids_no))])
        beta, bias = _machine(x, y, weight)
        model.weights, model.bias = np.zeros(SLOTS, dtype=np.float32), bias
        model.weights[used] = (root @ beta) @ base
        every = sorted({*in_bad, *in_good})
        margin = dict(zip(every, model.margins(every).tolist()))
        hard = sorted({*hard, *sorted(in_good, key=lambda w: (-margin[w], w))[:600]})
    del memo, telling
    words = sorted({w for ws, _ in rest for w in ws} - margin.keys())
    margin.update(zip(words, model.margins(words).tolist()))
    x = np.array([text_features([margin[w] for w in ws]) for ws, _ in rest])
    model.logistic = _logistic(x, np.array([y for _, y in rest], dtype=float))
    return model


def _spread(ids: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    """Pieces that lie far from each other, each drawn by its squared distance from those before it."""
    ids = ids[np.sort(rng.permutation(len(ids))[:800])]
    if len(ids) <= count:
        return ids
    near = np.full(len(ids), 2.0)
    chosen = []
    for _ in range(count):
        k = int(rng.choice(len(ids), p=near / near.sum()))
        chosen.append(k)
        near = np.minimum(near, np.maximum(2 - 2 * dot(ids, profile(ids[k : k + 1])), 1e-9))
    return ids[chosen]


def held_out(row_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(row_id.cast("string")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE
) -> Model:
    """Machine from a bounded sample: at most `sample` texts of each label, the first by a hash of the id.

    Ids that are held out, null ids, and null labels are left out.
    """
    usable = labels.where(~held_out(F.col(id_col)) & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    usable = usable.select(F.col(id_col).alias("id"), (F.col(label_col) != 0).cast("int").alias("label")).dropDuplicates(["id"])
    order = F.xxhash64("id")
    picked = None
    for label in (0, 1):
        part = usable.where(F.col("label") == label).orderBy(order, "id").limit(sample)
        picked = part if picked is None else picked.unionByName(part)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")  # 2 * sample rows at most
    schema = T.StructType([docs.schema[id_col].__class__("id", docs.schema[id_col].dataType), T.StructField("label", T.IntegerType()), T.StructField("words", T.ArrayType(T.StringType()))])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [sorted(words_of(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.string()))], names=["id", "label", "words"])

    rows = arrow_map(texts.select("id", "text", "label"), run, schema)
    found = [(r.id, [sys.intern(w) for w in r.words], r.label) for r in rows.toLocalIterator()]
    return fit([(words, label) for _, words, label in sorted(found)])


def _scorer(model: Model):
    """Function from texts to (probabilities, worst words), with a bounded memo of margins."""
    known: dict[str, float] = {}
    older: dict[str, float] = {}

    def run(texts: list[str | None]) -> tuple[np.ndarray, list[str | None]]:
        nonlocal known, older
        sets = [words_of(t) for t in texts]
        if len(known) > 150_000:  # the older half goes
            known, older = {}, known
        fresh = set().union(*sets) - known.keys()
        known.update((w, older[w]) for w in fresh & older.keys())
        bare: dict[str, list[str]] = {}
        for w in fresh - older.keys():
            bare.setdefault(w.strip(_STRIP), []).append(w)
        forms = sorted(bare)
        for form, margin in zip(forms, model.margins(forms).tolist()):
            for w in bare[form]:
                known[w] = margin
        x = np.array([text_features([known[w] for w in ws]) for ws in sets]).reshape(len(sets), 2)
        return model.probability(x), [max(ws, key=lambda w: (known[w], w)) if ws else None for ws in sets]

    return run


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score (0 to 1, higher: likelier toxic) and worst word of every whole text.

    Returns id_col, score double, worst string (null if there is no word); one row for each input row. Null
    and empty texts get the score of a text without words. Other columns are left out. No shuffle.
    """
    schema = T.StructType([df.schema[id_col], T.StructField("score", T.DoubleType(), False), T.StructField("worst", T.StringType())])
    shipped = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scorer = _scorer(shipped.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                cut = batch.slice(at, 256)
                scores, worst = scorer(cut.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([cut.column(0), pa.array(scores, pa.float64()), pa.array(worst, pa.string())], names=[id_col, "score", "worst"])

    return arrow_map(df.select(id_col, text_col), run, schema)


def keep_clean(df: DataFrame, model: Model, at: float = 0.7, text_col: str = "text") -> DataFrame:
    """Rows of df with a score below `at`, all columns kept. Null and empty texts stay. No shuffle."""
    shipped, place = df.sparkSession.sparkContext.broadcast(model), df.columns.index(text_col)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scorer = _scorer(shipped.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                cut = batch.slice(start, 256)
                texts = cut.column(place).to_pylist()
                scores, _ = scorer(texts)
                yield cut.filter(pa.array([s < at or not t for s, t in zip(scores, texts)]))

    return arrow_map(df, run, df.schema)
