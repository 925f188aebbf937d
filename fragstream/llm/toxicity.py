"""Toxicity: a counterfactually regularised classifier over the words and word beginnings that a text holds.

Each labelled text is compared with a twin in which identity terms are swapped
for others of their kind; the loss has, besides the log loss, the squared
difference of the two logits, so that naming a group does not move the score.
The terms are a public list of names of groups, where the labelled texts hold
them, and further groups that the texts themselves give: common words that tell
nothing about the label and stand in like contexts. All terms that are swapped
are features of the model, so that what the log loss would read into one of
them is what the penalty takes back.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytesgrams import FOLD, LETTER, prefixes, slices, word_hashes, words
from .common import held_out, labelled_sample
from .quality import scored

#: Labelled rows to learn from at most; each is a whole text.
TRAIN_ROWS = 6000
BITS, BEGINNINGS = 20, (4, 5, 6, 7, 8)
#: Features of the model at most: the ones whose presence tells the classes apart best.
KEPT, LEAST_DOCS = 4096, 3
STEPS, RATE, DECAY, FAIRNESS, SEED = 800, 1.5, 2e-5, 1.0, 9
#: A row weighs as the size of its class to minus this power: 1 would make the classes even, 0 the rows.
BALANCE = 0.75
HELD_OUT = (5, 0)

#: Terms that name groups, by kind; a swap takes another term of the same row.
IDENTITY = (
    ("women", "men", "girls", "boys", "frauen", "männer", "femmes", "hommes", "mujeres", "hombres"),
    ("woman", "man", "girl", "boy", "frau", "mann", "femme", "homme", "mujer", "hombre"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "muslime", "christen", "juden", "musulmans", "chrétiens", "juifs", "musulmanes", "cristianos", "judíos"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant"),
    ("black", "white", "asian", "african", "european", "latino", "arab", "indigenous"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("immigrants", "refugees", "foreigners", "natives", "migrants", "einwanderer", "immigrés", "inmigrantes"),
    ("americans", "mexicans", "germans", "french", "spaniards", "turks", "russians", "chinese"),
    ("old", "young", "elderly", "disabled", "deaf", "blind"),
)
#: Learned groups: of so many of the commonest neutral words, in groups of so many, whose contexts are that alike (cosine).
COMMON, GROUP, ALIKE = 96, 4, 0.6
#: A word is common if this share of the texts holds it, and neutral if the likelihood ratio of its presence stays below chance at 1 in 20.
COMMON_SHARE, CHANCE = 0.02, 3.84
_WORD = re.compile(r"[^\W\d_]+")

Groups = Sequence[Sequence[str]]


class Swaps:
    """Swaps the terms of groups for one another."""

    def __init__(self, groups: Groups = IDENTITY):
        self.others = {w: [x for x in row if x != w] for row in groups for w in row}

    def drawn(self, words_: Iterable[str], rng: np.random.Generator) -> dict[str, str]:
        """For each term among a text's lower-cased words another one of its group."""
        found = sorted(set(words_) & self.others.keys())
        return {w: self.others[w][int(rng.integers(len(self.others[w])))] for w in found}

    def twin(self, text: str, rng: np.random.Generator) -> str | None:
        """The text with every term swapped, for the same one throughout; None if it has none."""
        chosen = self.drawn((w.lower() for w in _WORD.findall(text)), rng)
        return _WORD.sub(lambda m: chosen.get(m[0].lower(), m[0]), text) if chosen else None


def tokens_of(texts: list[str]) -> list[list[str]]:
    """The words of letters of each text, lower-cased."""
    return [_WORD.findall(t.lower()) for t in texts]


def groups_of(tokens: list[list[str]], y: np.ndarray, seed: Groups = IDENTITY) -> list[list[str]]:
    """Groups to swap: the listed terms that occur in the texts, with the others of their row, and learned groups of common neutral words of like context.

    A learned group is a word and the words nearest to it by what comes right
    before and after them. Words whose presence tells the classes apart are in
    none, nor are listed ones.
    """
    present = [set(t) for t in tokens]
    df = Counter(w for s in present for w in s)
    found = [list(row) for row in seed if any(w in df for w in row)]
    toxic = Counter(w for s, label in zip(present, y, strict=True) if label for w in s)
    n1, listed = float(y.sum()), {w for row in seed for w in row}
    words_ = [w for w, n in sorted(df.items(), key=lambda x: (-x[1], x[0])) if n >= max(LEAST_DOCS, COMMON_SHARE * len(tokens)) and len(w) > 1]
    around = {w: i for i, w in enumerate(words_[: 4 * COMMON])}
    worth = _evidence(np.array([toxic[w] for w in words_], float), np.array([df[w] - toxic[w] for w in words_], float), n1, len(y) - n1)
    neutral = [w for w, g in zip(words_, worth, strict=True) if g < CHANCE and w not in listed][:COMMON]
    if len(neutral) < 2:
        return found
    at = {w: i for i, w in enumerate(neutral)}
    context = np.zeros((len(neutral), 2 * len(around)))
    for t in tokens:
        for i, w in enumerate(t):
            if (r := at.get(w)) is not None:
                if i and (c := around.get(t[i - 1])) is not None:
                    context[r, c] += 1
                if i + 1 < len(t) and (c := around.get(t[i + 1])) is not None:
                    context[r, len(around) + c] += 1
    context = np.sqrt(context)
    context /= np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-9)
    like = context @ context.T
    free = np.ones(len(neutral), bool)
    for i in range(len(neutral)):
        if free[i]:
            free[i] = False
            near = [j for j in np.argsort(-like[i], kind="stable") if free[j] and like[i, j] >= ALIKE][: GROUP - 1]
            if near:
                free[near] = False
                found.append([neutral[j] for j in (i, *near)])
    return found


def features(data: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, row) of every word of letters, A-Z lower-cased, and of the beginnings of longer words."""
    shift = np.uint64(64 - BITS)
    data = FOLD[data]
    start, end, row = words(data, off, LETTER[data])
    yield (word_hashes(data, start, end) >> shift).astype(np.int64), row
    for n in BEGINNINGS:
        h, at = prefixes(data, start, end, n)
        yield (h >> shift).astype(np.int64), row[at]


@dataclass(frozen=True)
class Model:
    """``slot`` maps a bucket to its kept feature plus 1 (0: not kept). ``rows`` texts were learned from, ``twins`` of them with a counterfactual twin."""

    slot: np.ndarray
    weight: np.ndarray
    bias: float
    rows: int = 0
    twins: int = 0

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probability of class 1 for each whole text, by the logarithm of how often its features occur."""
        out = np.full(len(texts), self.bias)
        k = len(self.weight)
        for a, b, data, off in slices(texts):
            seen = []
            for bucket, row in features(data, off):
                slot = self.slot[bucket]
                ok = np.flatnonzero(slot)
                seen.append(row[ok] * k + slot[ok] - 1)
            pairs, n = np.unique(np.concatenate(seen), return_counts=True)
            out[a:b] += np.bincount(pairs // k, self.weight[pairs % k] * np.log2(1 + n), b - a)
        return 1 / (1 + np.exp(-np.clip(out, -50, 50)))


def _counted(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, counts) of each text in turn: what is held does not grow with the rows."""
    for _, _, data, off in slices(pa.array(texts, pa.string()), 1):
        yield np.unique(np.concatenate([b for b, _ in features(data, off)]), return_counts=True)


def _buckets(terms: list[str]) -> np.ndarray:
    """The buckets of whole words."""
    if not terms:
        return np.zeros(0, np.int64)
    data, off = next((d, o) for _, _, d, o in slices(pa.array([" ".join(terms)], pa.string())))
    return np.unique(next(features(data, off))[0])


def _evidence(a: np.ndarray, b: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """Likelihood ratio (G squared) of presence in a of n1 and b of n0 texts against one common share."""
    part = lambda x, n, p: np.where(x > 0, x * np.log(np.maximum(x, 1e-9) / np.maximum(n * p, 1e-9)), 0)
    p = (a + b) / (n1 + n0)
    return 2 * (part(a, n1, p) + part(b, n0, p) + part(n1 - a, n1, 1 - p) + part(n0 - b, n0, 1 - p))


def train(rows: list[tuple[str, int]], fairness: float = FAIRNESS, groups: Groups | None = None) -> Model:
    """Learns from (text, label); without both classes, or a feature that tells them apart, every score is the share of class 1.

    Features are those whose presence in toxic texts is beyond chance, by the
    likelihood ratio, best first, and the terms that are swapped, whatever they
    tell. ``groups`` are found in the texts if not given. Gradient descent over
    all rows at once.
    """
    y = np.array([label for _, label in rows], float)
    share = float(y.mean()) if len(y) else 0.0
    alike = Model(np.zeros(1 << BITS, np.int32), np.zeros(1), float(np.log(max(share, 1e-3) / max(1 - share, 1e-3))), len(y))
    if share in (0.0, 1.0):
        return alike
    rng = np.random.default_rng(SEED)
    texts = [t for t, _ in rows]
    tokens = tokens_of(texts)
    groups = groups_of(tokens, y) if groups is None else groups
    swaps = Swaps(groups)
    twins = [swaps.drawn(t, rng) for t in tokens]
    df = np.zeros((2, 1 << BITS))
    for (found, _), label in zip(_counted(texts), y, strict=True):
        df[int(label), found] += 1
    n1, n0 = y.sum(), len(y) - y.sum()
    worth = _evidence(df[1], df[0], n1, n0)
    # as many features are tried as occur: chance alone exceeds this about once
    least = 2 * np.log(max(2, int((df.sum(0) > 0).sum())))
    worth[(df[1] / n1 <= df[0] / n0) | (df.sum(0) < LEAST_DOCS) | (worth < least)] = 0
    kept = np.argsort(-worth, kind="stable")[: min(KEPT, int((worth > 0).sum()))]
    if not len(kept):
        return alike
    kept = np.union1d(kept, _buckets([w for row in groups for w in row]))
    slot = np.zeros(1 << BITS, np.int32)
    slot[kept] = np.arange(1, len(kept) + 1)

    k = len(kept)

    def counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(row * k + feature, count) of all kept features of some texts."""
        parts = [np.zeros(0, np.int64)]
        for a, _, data, off in slices(pa.array(texts, pa.string())):
            for bucket, row in features(data, off):
                ok = np.flatnonzero(found := slot[bucket])
                parts.append((row[ok] + a) * k + found[ok] - 1)
        return np.unique(np.concatenate(parts), return_counts=True)

    pair, n = counts(texts)
    cols, at, val = pair % k, pair // k, np.log2(1 + n)
    # what a swap takes from a text and what it puts there: (row, feature, difference of values) of the features that change
    order = np.array([i for i, t in enumerate(twins) if t], int)
    taken, put = counts([" ".join(x for x in tokens[i] if x in twins[i]) for i in order]), counts([" ".join(twins[i][x] for x in tokens[i] if x in twins[i]) for i in order])
    moved, back = np.unique(np.concatenate([taken[0], put[0]]), return_inverse=True)
    by = np.bincount(back, np.concatenate([-taken[1], put[1]]), len(moved)) if len(moved) else np.zeros(0)
    drow, dcol = moved // k, moved % k
    before = np.zeros(len(moved))
    place = np.minimum(np.searchsorted(pair, order[drow] * k + dcol), len(pair) - 1) if len(moved) and len(pair) else np.zeros(0, int)
    if len(place):
        held = pair[place] == order[drow] * k + dcol
        before[held] = n[place[held]]
    diff = np.log2(1 + before) - np.log2(1 + np.maximum(before + by, 0))
    w, b, speed_w, speed_b = np.zeros(len(kept)), 0.0, np.zeros(len(kept)), 0.0
    weight = np.where(y == 1, n1**-BALANCE, n0**-BALANCE)
    weight /= weight.sum()
    for step in range(STEPS):
        z = np.bincount(at, w[cols] * val, len(y)) + b
        g = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y)
        gw = np.bincount(cols, g[at] * val, len(kept)) + DECAY * w
        if len(order):
            gap = fairness * 2 * np.bincount(drow, w[dcol] * diff, len(order)) / len(order)
            gw += np.bincount(dcol, gap[drow] * diff, len(kept))
        speed_w, speed_b = 0.99 * speed_w + 0.01 * gw**2, 0.99 * speed_b + 0.01 * g.sum() ** 2
        rate = RATE * 0.1 * (1 - step / STEPS)
        w -= rate * gw / (np.sqrt(speed_w / (1 - 0.99 ** (step + 1))) + 1e-6)
        b -= rate * g.sum() / (np.sqrt(speed_b / (1 - 0.99 ** (step + 1))) + 1e-6)
    return Model(slot, w, float(b), len(y), len(order))


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    """Trains on at most ``rows`` labelled whole texts that are not held out."""
    return train(labelled_sample(docs, labels, target, mod=HELD_OUT[0], rest=HELD_OUT[1], rows=rows, seed=SEED))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, held_out, score and predicted, as op9's contract says.

    Null and empty texts get the score of no features; rows that repeat score
    alike; a row with a null id is scored and counts as held out; extra columns
    are not read; an empty table gives an empty result.
    """
    model = fit(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), labels)
    got = scored(docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("__text")), model, "__text")
    return got.select(id_col, held_out(id_col, *HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
