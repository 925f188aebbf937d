"""Quality classifier: averaged embeddings of hashed words, word pairs, shapes of word runs and character n-grams, softmax output, numpy SGD."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shipping import ship
from .bytesgrams import POWERS, SPACE, P, lean, mix, slices, word_hashes, words
from .common import held_out, labelled_rows

#: Labelled rows to learn from at most; each is a whole text.
TRAIN_ROWS = 2000
BITS, GRAMS, SHAPES, DIM = 17, (2, 3, 4), (2, 3, 4), 10
EPOCHS, RATE, SEED = 6, 0.4, 4
#: What stands for a word's ends among code points, none of which is that large.
MARK = 0x110000
HELD_OUT = (5, 0)
KEEP = 0.3


def features(data: np.ndarray, off: np.ndarray, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, row) of every word, every pair of neighbouring words, the shape of every run of n words, and every run of n characters (code points) of a word between marks of its ends.

    The shape of a run tells which of its words are the same, whatever they are.
    """
    shift = np.uint64(64 - bits)
    start, end, row = words(data, off, ~SPACE[data])
    h = word_hashes(data, start, end)
    yield (h >> shift).astype(np.int64), row
    pair = row[1:] == row[:-1]
    yield (mix(h[:-1][pair] * P + h[1:][pair]) >> shift).astype(np.int64), row[1:][pair]
    for n in SHAPES:
        m = max(0, len(h) - n + 1)
        at = np.flatnonzero(row[n - 1 :] == row[:m]) if m else np.zeros(0, np.int64)
        shape = np.full(len(at), n, np.uint64)
        for i in range(n):
            for j in range(i + 1, n):
                shape = shape * np.uint64(2) + (h[at + i] == h[at + j])
        yield (mix(shape * P) >> shift).astype(np.int64), row[at]
    marked, rows = characters(data, off)
    value = mix(marked.astype(np.uint64) * P)
    gap = marked == MARK
    for n in GRAMS:
        m = len(marked) - n + 1
        if m <= 0:
            continue
        ok = ~gap[1:m + 1] if n > 2 else np.ones(m, bool)  # a mark only at either end
        for j in range(2, n - 1):
            ok &= ~gap[j : j + m]
        if n == 2:
            ok = ~(gap[:m] & gap[1:])
        at = np.flatnonzero(ok)
        h = np.full(len(at), POWERS[n])
        for j in range(n):
            h += value[at + j] * POWERS[j]
        yield (mix(h) >> shift).astype(np.int64), rows[at + (marked[at] == MARK)]


def characters(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, row) of all texts one after the other, with one MARK before, between and after words in place of white space."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    first = (data & 0xC0) != 0x80
    rows = np.repeat(np.arange(len(off) - 1), np.diff(off))[first]
    points = np.where((points < 128) & SPACE[np.minimum(points, 255)], MARK, points)
    # a mark where a row begins, then no two marks in a row
    begins = np.flatnonzero(np.diff(rows, prepend=-1))
    points, rows = np.insert(points, begins, MARK), np.insert(rows, begins, rows[begins] if len(begins) else [])
    points, rows = np.append(points, np.uint32(MARK)), np.append(rows, rows[-1:] if len(rows) else [0])
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != MARK) | (points[:-1] != MARK)
    return points[keep], rows[keep]


@dataclass(frozen=True)
class Model:
    """What scoring needs of the network: by bucket, the logit that its embedding adds for class 1 over class 0."""

    weight: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probability of class 1 for each whole text; without any feature it is that of the bias."""
        out = np.zeros(len(texts))
        for a, b, data, off in slices(texts):
            total, count = np.zeros(b - a), np.zeros(b - a)
            for bucket, row in features(data, off):
                total += np.bincount(row, self.weight[bucket], b - a)
                count += np.bincount(row, minlength=b - a)
            out[a:b] = total / np.maximum(count, 1)
        return 1 / (1 + np.exp(-np.clip(out + self.bias, -50, 50)))


def train(rows: list[tuple[str, int]], classes: int = 2) -> Model:
    """Learns from (text, label); with one class only, or no rows, every score is that class's share (0.5 without rows).

    A document is the mean of its features' vectors; the softmax layer and the
    vectors learn together by stochastic gradient descent with a falling rate.
    Classes weigh the same, however rare one is.
    """
    y = np.array([label for _, label in rows], int)
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.5
        return Model(np.zeros(1 << BITS, np.float32), float(np.log(max(share, 1e-3) / max(1 - share, 1e-3))))
    # all features one after the other in two large arrays, which go back to the system as a whole
    ids, shares, ends = np.empty(1 << 20, np.int32), np.empty(1 << 20, np.float32), [0]
    for _, _, data, off in slices(pa.array([t for t, _ in rows]), 1):  # row by row
        found, count = np.unique(np.concatenate([b for b, _ in features(data, off)]), return_counts=True)
        ends.append(ends[-1] + len(found))
        if ends[-1] > len(ids):
            more = max(len(ids), len(found))
            ids, shares = np.concatenate([ids, np.empty(more, np.int32)]), np.concatenate([shares, np.empty(more, np.float32)])
        ids[ends[-2] : ends[-1]], shares[ends[-2] : ends[-1]] = found, count / max(1, count.sum())
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    out = np.zeros((DIM, classes), np.float32)
    bias = np.zeros(classes, np.float32)
    balance = len(y) / (classes * np.maximum(np.bincount(y, minlength=classes), 1))
    steps, done = EPOCHS * len(y), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(y)):
            found, share = ids[ends[i] : ends[i + 1]], shares[ends[i] : ends[i + 1]]
            rate = np.float32(RATE * (1 - done / steps) * balance[y[i]] ** 0.5)
            done += 1
            hidden = share @ vectors[found]
            z = hidden @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = out @ p
            out -= rate * np.outer(hidden, p)
            bias -= rate * 0.1 * p
            vectors[found] -= (rate * len(found) ** 0.5) * np.outer(share, back)
    return Model((vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", rows: int = TRAIN_ROWS) -> Model:
    """Trains on at most ``rows`` labelled whole texts that are not held out, in one task: the driver gets the weights, no text."""
    ship(docs.sparkSession)

    @lean
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
        model = train(held)
        yield pa.RecordBatch.from_arrays([pa.array([model.weight.tobytes()], pa.binary()), pa.array([model.bias], pa.float64())], ["weight", "bias"])

    with labelled_rows(docs, labels, target, mod=HELD_OUT[0], rest=HELD_OUT[1], rows=rows, seed=SEED) as some:
        found = some.repartition(1).sortWithinPartitions("__i").select("text", "__y").mapInArrow(learn, "weight binary, bias double").first()
    return Model(np.frombuffer(found["weight"], np.float32), found["bias"]) if found else train([])


def scored(docs: DataFrame, model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All rows and columns with a score in 0 to 1 by the whole text; a null text scores as an empty one.

    The score comes last; a column that already has its name is replaced.
    """
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model)  # about a megabyte, whatever the corpus
    at = docs.columns.index(text_col)
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))  # names may hold dots, or be the same
    stay = [i for i, c in enumerate(docs.columns) if c != score_col]
    out = [*(f"c{i}" for i in stay), "score"]

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in stay), pa.array(held.value.scores(batch.column(at)), pa.float64())], out)

    schema = T.StructType([*(plain.schema.fields[i] for i in stay), T.StructField("score", T.DoubleType())])
    return plain.mapInArrow(run, schema).toDF(*(docs.columns[i] for i in stay), score_col)


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, held_out, score and predicted, as op4's contract says.

    Null and empty texts get the score of no features; rows that repeat score
    alike; a row with a null id is scored and counts as held out; extra columns
    are not read; an empty table gives an empty result.
    """
    model = fit(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), labels)
    got = scored(docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("__text")), model, "__text")
    return got.select(id_col, held_out(id_col, *HELD_OUT).alias("held_out"), "score", (F.col("score") >= KEEP).cast("int").alias("predicted"))
