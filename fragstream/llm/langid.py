"""Language ID: a bidirectional gated recurrent network over bytes, trained in numpy by backpropagation through time.

The network runs over the bytes of a text, white space and all, labels every
byte position with language probabilities and pools them over the document. A
text is read in windows, side by side, each of which begins CONTEXT bytes before
the positions that it labels and ends as many after them: both directions have
seen words and their neighbours when they label a position.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import ship
from .bytesgrams import lean, slices
from .common import TRAIN_BYTES, Scratch, bounded, held_out

#: Texts to learn from at most: of each language, and of all together (then each has fewer, but LEAST_ROWS at least); each is a whole text.
TRAIN_ROWS, TOTAL_ROWS, LEAST_ROWS = 400, 4000, 8
WIDTH, EMBED = 8, 12
#: Positions that a window labels, and how many more it reads on either side.
CORE, CONTEXT = 320, 16
STEPS, BATCH, LENGTH, RATE, SEED = 400, 192, 40, 1.2e-2, 5
#: Label logits held at a time while reading; windows are read in batches of so many divided by positions and languages.
LOGITS = 6 << 20
PAD = 256  # stands for positions before and after a text, which leave the state as it is
HELD_OUT = (4, 2)


class Network:
    """Two GRUs of WIDTH cells, one for each direction, and a softmax over both states at each position.

    Gates are clip(x / 4 + 1 / 2, 0, 1) and candidates clip(x, -1, 1): straight
    pieces in place of the logistic function and the hyperbolic tangent, which
    would take most of the time. Arrays are (cells, windows), so that each gate
    is one block.
    """

    def __init__(self, langs: list[str]):
        rng = np.random.default_rng(SEED)
        self.langs = langs
        init = lambda *shape: (rng.standard_normal(shape) / shape[1] ** 0.5).astype(np.float32)
        n = max(1, len(langs))
        self.p = {"E": init(EMBED, 256) * 16, "O": init(n, 2 * WIDTH), "o": np.zeros((n, 1), np.float32)}
        for d in "fb":
            self.p |= {f"W{d}": init(3 * WIDTH, EMBED), f"U{d}": init(3 * WIDTH, WIDTH), f"b{d}": np.zeros((3 * WIDTH, 1), np.float32), f"c{d}": np.zeros((WIDTH, 1), np.float32)}

    def side(self, d: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(what each byte adds to reset, update and candidate; what the state adds; the candidate's own share), gates already divided by 4.

        The pad opens the update gate, so that the state stays as it is.
        """
        scale = np.repeat([0.25, 0.25, 1], WIDTH).astype(self.p["E"].dtype)[:, None]
        table = np.zeros((3 * WIDTH, 257), self.p["E"].dtype)
        table[:, :256] = self.p[f"W{d}"] @ self.p["E"] + self.p[f"b{d}"]
        table *= scale
        table[: 2 * WIDTH] += 0.5
        table[WIDTH : 2 * WIDTH, PAD] = 1e4
        return np.ascontiguousarray(table), self.p[f"U{d}"] * scale, self.p[f"c{d}"]

    def labels(self, seq: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Label probabilities (length, langs, windows) of windows (windows, length) of bytes and pads."""
        by_time = np.ascontiguousarray(seq.T.astype(np.intp))
        length, n = by_time.shape
        kind = self.p["E"].dtype
        out = np.empty((length, len(self.p["O"]), n), kind)
        x, u = np.empty((3 * WIDTH, n), kind), np.empty((3 * WIDTH, n), kind)
        for k, d in enumerate("fb"):
            table, U, c = self.side(d)
            O = np.ascontiguousarray(self.p["O"][:, k * WIDTH : (k + 1) * WIDTH])  # noqa: E741
            h = np.zeros((WIDTH, n), kind)
            if keep is not None:
                keep[d] = {name: np.empty((length, size, n), kind) for name, size in (("h", WIDTH), ("to", WIDTH), ("rz", 2 * WIDTH), ("un", WIDTH), ("new", WIDTH))}
            for t in range(length) if d == "f" else range(length - 1, -1, -1):
                np.take(table, by_time[t], axis=1, out=x, mode="clip")
                np.matmul(U, h, out=u)
                rz, new = x[: 2 * WIDTH], u[2 * WIDTH :]
                rz += u[: 2 * WIDTH]
                np.clip(rz, 0, 1, out=rz)
                new += c
                if keep is not None:
                    keep[d]["h"][t], keep[d]["rz"][t], keep[d]["un"][t] = h, rz, new
                new *= rz[:WIDTH]
                new += x[2 * WIDTH :]
                np.clip(new, -1, 1, out=new)
                h -= new
                h *= rz[WIDTH:]
                h += new
                if keep is not None:
                    keep[d]["new"][t], keep[d]["to"][t] = new, h
                if d == "f":
                    np.matmul(O, h, out=out[t])
                else:
                    out[t] += O @ h
        out += self.p["o"]
        out -= out.max(1, keepdims=True)
        np.exp(out, out=out)
        out /= out.sum(1, keepdims=True)
        return out

    def gradients(self, seq: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy over all positions that are no pads, by backpropagation through time."""
        keep: dict = {}
        y = self.labels(seq, keep)
        n, length = seq.shape
        real = (seq != PAD).T
        y[:, label, np.arange(n)] -= 1
        y *= (real / max(1, real.sum()))[:, None].astype(y.dtype)
        flat = lambda a: np.moveaxis(a, 1, 0).reshape(a.shape[1], -1)  # noqa: E731  (cells, length * windows)
        g = {"E": np.zeros_like(self.p["E"]), "O": np.concatenate([flat(y) @ flat(keep[d]["to"]).T for d in "fb"], 1), "o": y.sum((0, 2))[:, None]}
        seen = seq.T.ravel()
        order = np.argsort(seen, kind="stable")
        found, first = np.unique(seen[order], return_index=True)
        for k, d in enumerate("fb"):
            U, back = self.p[f"U{d}"], np.matmul(self.p["O"][:, k * WIDTH : (k + 1) * WIDTH].T, y)
            s = keep[d]
            r, z = s["rz"][:, :WIDTH], s["rz"][:, WIDTH:]
            # the slope of each piece, a quarter for a gate within its bounds, one for a candidate
            slope, flat_new = (s["rz"] > 0) & (s["rz"] < 1), np.abs(s["new"]) < 1
            dx = np.empty((length, 3 * WIDTH, n), y.dtype)
            du = np.empty_like(dx)
            dh = np.zeros((WIDTH, n), y.dtype)
            for t in range(length - 1, -1, -1) if d == "f" else range(length):
                dh = dh + back[t]
                dn = dh * (1 - z[t]) * flat_new[t]
                dx[t, :WIDTH] = dn * s["un"][t]
                dx[t, WIDTH : 2 * WIDTH] = dh * (s["h"][t] - s["new"][t])
                dx[t, : 2 * WIDTH] *= 0.25 * slope[t]
                dx[t, 2 * WIDTH :] = dn
                du[t] = dx[t]
                du[t, 2 * WIDTH :] *= r[t]
                dh = dh * z[t] + U.T @ du[t]
            g[f"c{d}"] = du[:, 2 * WIDTH :].sum((0, 2))[:, None]
            g[f"U{d}"] = flat(du) @ flat(s["h"]).T
            dtable = np.zeros((3 * WIDTH, 257), y.dtype)
            dtable[:, found] = np.add.reduceat(flat(dx)[:, order], first, axis=1)
            dtable = dtable[:, :256]
            g[f"W{d}"], g[f"b{d}"] = dtable @ self.p["E"].T, dtable.sum(1, keepdims=True)
            g["E"] = g["E"] + self.p[f"W{d}"].T @ dtable
        return g

    def learn(self, texts: list[str], labels: list[int]) -> Network:
        """Adam over batches of windows at random places: languages weigh the same, and so do the texts of one."""
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        size = np.array([len(x) for x in raw], np.int64)
        start = np.cumsum(size) - size
        own = [np.flatnonzero((np.array(labels) == k) & (size > 0)) for k in range(len(self.langs))]
        own = {k: x for k, x in enumerate(own) if len(x)}
        if len(own) < 2:
            return self
        rng = np.random.default_rng(SEED)
        kinds = np.array(sorted(own))
        first, second = {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}
        for step in range(1, STEPS + 1):
            label = kinds[rng.integers(len(kinds), size=BATCH)]
            row = np.array([own[k][int(x * len(own[k]))] for k, x in zip(label.tolist(), rng.random(BATCH), strict=True)])
            at = (rng.random(BATCH) * np.maximum(1, size[row] - LENGTH + 1)).astype(np.int64)
            rate = RATE * (1 - 0.9 * step / STEPS)
            for k, v in self.gradients(cut(data, start[row], start[row] + size[row], start[row] + at, LENGTH), label).items():
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.99 * second[k] + 0.01 * v * v
                self.p[k] = (self.p[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        return self


def cut(data: np.ndarray, low: np.ndarray, high: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Windows (windows, length) of the data from ``at`` on, with pads outside of ``low`` to ``high``."""
    place = at[:, None] + np.arange(length)
    inside = (place >= low[:, None]) & (place < high[:, None])
    return np.where(inside, data[np.clip(place, 0, max(0, len(data) - 1))].astype(np.int16), np.int16(PAD))


class Reader:
    """Labels the positions of whole texts and pools them."""

    def __init__(self, net: Network):
        self.net, self.langs = net, len(net.langs)
        self.batch = max(16, LOGITS // ((CORE + 2 * CONTEXT) * self.langs))

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        """(texts, langs): the mean label probabilities over all byte positions; zeros for a text without any."""
        out = np.zeros((len(texts), self.langs))
        for a, b, data, off in slices(texts, self.batch * CORE):
            size = np.diff(off)
            n = -(-size // CORE)
            row = np.repeat(np.arange(b - a), n)
            at = off[row] + (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * CORE - CONTEXT
            sums = np.zeros((b - a, self.langs))
            for i in range(0, len(row), self.batch):
                some = slice(i, i + self.batch)
                seq = cut(data, off[row[some]], off[row[some] + 1], at[some], CORE + 2 * CONTEXT)
                p = self.net.labels(seq)[CONTEXT : CONTEXT + CORE]
                p *= (seq[:, CONTEXT : CONTEXT + CORE] != PAD).T[:, None, :]
                np.add.at(sums, row[some], p.sum(0).T)
            out[a:b] = sums / np.maximum(size, 1)[:, None]
        return out


def fit(docs: DataFrame, rows: int = TRAIN_ROWS, total: int = TOTAL_ROWS, most_bytes: int = TRAIN_BYTES) -> Network:
    """Learns from (doc_id, text, lang) of documents that are not held out.

    Of each language the first ``rows`` documents in a seeded order; with many
    languages fewer of each, so that all are about ``total``, but no language is
    left out. Of all texts together the first ``most_bytes`` in such an order that
    each language's first text comes before any one's second.
    """
    known = docs.where("text is not null and lang is not null").where(~held_out("doc_id", *HELD_OUT)).select("doc_id", "lang")
    with Scratch(docs.sparkSession) as scratch:
        counts = scratch.table(known.groupBy("lang").count(), "langs")  # a row a language
        n = counts.count()
        if not n:
            return Network([])
        rows = min(rows, max(LEAST_ROWS, total // n))
        # a seeded share of each language, about twice what is taken, so that the ranking sees few rows of a frequent one
        some = known.join(F.broadcast(counts.withColumnRenamed("lang", "__l")), F.col("lang") == F.col("__l"))
        some = some.where(F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), F.lit(1_000_000)) < (2.0 * rows + 100) / F.col("count") * 1_000_000)
        place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id"))
        drawn = some.select("lang", "doc_id").distinct().withColumn("__p", place).where(F.col("__p") <= rows).select(F.col("doc_id").alias("__i"), F.col("lang").alias("__l"), "__p")
        got = docs.select("doc_id", "text", "lang").join(F.broadcast(drawn), (F.col("doc_id") == F.col("__i")) & (F.col("lang") == F.col("__l"))).where("text is not null")
        got = got.groupBy("__i", "__l", "__p").agg(F.min("text").alias("text"))  # an id that many rows share counts once for a language
        found = sorted((r["__l"], r["__i"], r["text"]) for r in bounded(got, scratch, ("__p", "__l", "__i"), most_bytes).collect())
    langs = sorted({x[0] for x in found})
    return Network(langs).learn([x[2] for x in found], [langs.index(x[0]) for x in found])


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: its id, held_out, lang_pred and score, as op5's contract says.

    ``und`` with score 0 stands for null texts, texts without a letter, and for
    all if nothing can be learned; equal probabilities go to the language first
    in order; rows that repeat get equal results; a null id counts as held out;
    extra columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    net = fit(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")))
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    und = F.lit("und")
    if not net.langs:
        return rows.select(F.col("__id").alias(id_col), held_out("__id", *HELD_OUT).alias("held_out"), und.alias("lang_pred"), F.lit(0.0).alias("score"))
    held = spark.sparkContext.broadcast(net)  # some thousand numbers

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(held.value)
        names = np.array(held.value.langs, object)
        for batch in batches:
            p = reader.probabilities(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(names[p.argmax(1)], pa.string()), pa.array(p.max(1).clip(0, 1), pa.float64())], ["id", "letters", "lang", "score"])

    letters = F.coalesce(F.col("__text").rlike(r"\p{L}"), F.lit(False))
    got = rows.select("__id", "__text", letters.alias("letters")).mapInArrow(run, rows.select(F.col("__id").alias("id"), F.lit(True).alias("letters"), F.lit("").alias("lang"), F.lit(0.0).alias("score")).schema)
    return got.select(F.col("id").alias(id_col), held_out("id", *HELD_OUT).alias("held_out"), F.when(F.col("letters"), F.col("lang")).otherwise(und).alias("lang_pred"), F.when(F.col("letters"), F.col("score")).otherwise(0.0).alias("score"))
