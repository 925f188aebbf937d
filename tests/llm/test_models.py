import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fragstream.llm import common, langid, quality, toxicity
from fragstream.llm.bytesgrams import POWERS, P, mix, word_hashes

from .conftest import prose

SF = "/root/testdata/sf0.01"


def held(df, target, labels):
    got = df.where("held_out").join(labels, "doc_id").select(target, "predicted").collect()
    return np.mean([r[0] == r[1] for r in got])


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")]


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    got = quality.quality(docs, labels)
    assert got.count() == docs.count() and held(got, "quality", labels) >= 0.95
    assert got.where("score < 0 or score > 1 or predicted <> cast(score >= 0.3 as int)").count() == 0


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    got = toxicity.toxicity(docs, labels)
    assert got.count() == docs.count() and held(got, "toxic", labels) >= 0.9


@pytest.mark.parametrize(("operator", "target"), [(quality.quality, "quality"), (toxicity.toxicity, "toxic")])
def test_held_out_labels_are_never_learned(tables, operator, target):
    docs, labels = tables
    flipped = labels.withColumn(target, F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col(target)).otherwise(F.col(target)))
    few = docs.where("doc_id < 60").withColumn("lang", F.lit("x")).withColumn("source", F.lit(None).cast("string"))
    model = lambda lab: [r.score for r in operator(docs, lab).where("doc_id < 60").orderBy("doc_id").collect()]
    assert model(labels) == model(flipped)
    assert few.count() == 60


@pytest.mark.parametrize("operator", [quality.quality, toxicity.toxicity])
def test_odd_rows_are_scored(docs, corpus, none, spark, operator):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(30)] + [(None, 1, 1), (3, None, None), (4, 1, 1)], "doc_id long, quality int, toxic int")
    got = operator(docs, labels).collect()
    assert len(got) == len(corpus) and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if r.doc_id in {c[0] for c in corpus if not c[1]}}
    assert len(empty) == 1
    assert operator(none, labels).collect() == []
    assert len({r.score for r in operator(docs, labels.where(F.lit(False))).collect()}) == 1


def by_hand_features(text):
    """Counts of a text's quality features, one word and one character at a time."""
    low = [x.encode() for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    one = lambda b: word_hashes(np.frombuffer(b, np.uint8), np.array([0]), np.array([len(b)]))[0]
    out, h = [], [one(b) for b in low]
    with np.errstate(over="ignore"):
        out += h + [mix(np.array([a * P + b]))[0] for a, b in zip(h, h[1:], strict=False)]
        for n in quality.SHAPES:
            for i in range(len(h) - n + 1):
                code = n
                for j in range(n):
                    for k in range(j + 1, n):
                        code = code * 2 + (h[i + j] == h[i + k])
                out.append(mix(np.array([np.uint64(code) * P]))[0])
        for w in low:
            marked = [quality.MARK, *map(ord, w.decode()), quality.MARK]
            for n in quality.GRAMS:
                for i in range(len(marked) - n + 1):
                    value = POWERS[n]
                    for j in range(n):
                        value = value + mix(np.array([np.uint64(marked[i + j]) * P]))[0] * POWERS[j]
                    out.append(mix(np.array([value]))[0])
    return np.array(out, np.uint64) >> np.uint64(64 - quality.BITS)


def test_quality_scores_equal_a_brute_force_version(spark, docs, corpus):
    """The model of the query, applied by hand: the mean over all features of what each adds."""
    rng = __import__("random").Random(8)
    model = quality.train([(prose(rng, 30) + ("!" * (i % 2)), i % 2) for i in range(60)])
    got = {(r.doc_id, r.text): r.score for r in quality.scored(docs, model).select("doc_id", "text", "score").collect()}
    for i, text, *_ in corpus:
        if text and len(text) > 3000:
            continue
        found = by_hand_features(text)
        logit = (model.weight[found].astype(float).sum() / max(1, len(found))) + model.bias
        assert got[i, text] == pytest.approx(1 / (1 + np.exp(-logit)), rel=1e-6), text


def test_a_score_column_is_replaced(docs, none):
    model = quality.train([("a b", 1), ("c d", 0)])
    for df in (docs, none):
        got = quality.scored(df, model)
        assert got.columns == [*(c for c in docs.columns if c != "score"), "score"] and got.count() == df.count()
        assert quality.scored(df, model, score_col="q").columns == [*docs.columns, "q"]


def test_repeated_words_and_symbols_are_junk():
    rng = __import__("random").Random(1)
    rows = []
    for i in range(120):
        w = prose(rng, 40).split()
        rows += [(" ".join(w), 1), (" ".join(x for x in w[:6] for _ in range(7)) if i % 2 else "&&& ".join(w), 0)]
    model = quality.train(rows)
    test = [" ".join(prose(rng, 50).split()), " ".join(["mora"] * 9 + ["lise"] * 8 + ["kexu"] * 9), "$$$ ".join(prose(rng, 30).split()).replace("$", "&")]
    a, b, c = model.scores(pa.array(test))
    assert a > 0.7 and b < 0.3 and c < 0.3


def test_counterfactual_penalty_frees_neutral_mentions():
    """Toxic rows name one group far more often; only the penalty keeps the name from counting."""
    rng = __import__("random").Random(2)
    insults = ["zorgel", "quabbig", "trovnik"]
    rows = []
    for i in range(400):
        toxic = i % 2
        w = prose(rng, 20).split()
        if toxic and rng.random() < 0.6:
            w.insert(3, rng.choice(insults))
        if rng.random() < (0.7 if toxic else 0.05):
            w.insert(7, "muslims")
        if rng.random() < 0.2:
            w.insert(9, "christians")
        rows.append((" ".join(w), toxic))
    neutral = [" ".join([*prose(rng, 12).split(), name]) for name in ("muslims", "christians") for _ in range(20)]
    gap = {}
    for fairness in (0.0, 1.0):
        s = toxicity.train(rows, fairness=fairness).scores(pa.array(neutral))
        gap[fairness] = abs(s[:20].mean() - s[20:].mean())
    assert gap[0.0] > 0.3 and gap[1.0] < gap[0.0] / 3
    fair = toxicity.train(rows, fairness=1.0)
    assert fair.scores(pa.array(["you zorgel " + prose(rng, 10)]))[0] > 0.5


def test_swaps_keep_all_else():
    rng = np.random.default_rng(0)
    assert toxicity.Swaps().twin("no such term: menu, blacken", rng) is None
    got = toxicity.Swaps().twin("The Women and a gay man.", rng)
    assert got != "The Women and a gay man." and got.startswith("The ") and got.endswith(".")
    assert toxicity.Swaps([["a", "b"]]).twin("a x a", rng) == "b x b"


def test_penalty_acts_on_the_labelled_texts_of_the_query(tables):
    """The texts hold no listed term: groups are learned, most rows get a twin, and the penalty changes the model."""
    docs, labels = tables
    rows = common.labelled_sample(docs, labels, "toxic", mod=5, rest=0, rows=toxicity.TRAIN_ROWS, seed=toxicity.SEED)
    fair, plain = toxicity.train(rows), toxicity.train(rows, fairness=0.0)
    assert fair.rows == len(rows) and fair.twins == plain.twins > 0.5 * len(rows)
    assert (fair.slot == plain.slot).all() and np.abs(fair.weight - plain.weight).max() > 0.01
    swaps = toxicity.Swaps(toxicity.groups_of(toxicity.tokens_of([t for t, _ in rows]), np.array([y for _, y in rows], float)))
    rng = np.random.default_rng(3)
    texts = [t for t, y in rows if not y]
    twins = [swaps.twin(t, rng) or t for t in texts]
    logit = lambda m, x: np.log((p := m.scores(pa.array(x)).clip(1e-9, 1 - 1e-9)) / (1 - p))
    gap = lambda m: np.mean((logit(m, texts) - logit(m, twins)) ** 2)
    assert gap(fair) < 0.5 * gap(plain)


def test_learned_groups_are_common_neutral_words():
    rng = __import__("random").Random(5)
    rows = []
    for i in range(300):
        w = [x for _ in range(30) for x in ("the", rng.choice(("red", "blue", "green")), rng.choice(("house", "tree")))]
        rows.append((" ".join(w + ["slur"] * (i % 2) + ["women"] * (i % 3 == 0)), i % 2))
    found = toxicity.groups_of(toxicity.tokens_of([t for t, _ in rows]), np.array([y for _, y in rows], float))
    assert set(found[0]) == set(toxicity.IDENTITY[0]) and not any("slur" in row for row in found)
    learned = [set(row) for row in found[1:]]
    assert {"red", "blue", "green"} in learned and {"house", "tree"} in learned


def test_gradients_are_those_of_the_loss():
    net = langid.Network(["a", "b", "c"])
    net.p = {k: v.astype(np.float64) * (0.1 if k == "E" else 1) for k, v in net.p.items()}  # small steps stay on one piece
    rng = np.random.default_rng(1)
    seq, label = rng.integers(0, 256, (5, 7)).astype(np.int16), np.array([0, 1, 2, 1, 0])
    seq[3, 4:], seq[4, :2] = langid.PAD, langid.PAD
    real = (seq != langid.PAD).T

    def loss():
        y = net.labels(seq)
        return -(np.log(y[:, label, np.arange(5)]) * real).sum() / real.sum()

    got = net.gradients(seq, label)
    assert set(got) == set(net.p)
    for name in net.p:
        at = np.unravel_index(np.abs(got[name]).argmax(), got[name].shape)
        old, eps = net.p[name][at], 1e-5
        net.p[name][at] = old + eps
        up = loss()
        net.p[name][at] = old - eps
        down = loss()
        net.p[name][at] = old
        assert got[name][at] == pytest.approx((up - down) / (2 * eps), rel=1e-3, abs=1e-7), name


def by_hand(net, raw):
    """Label probabilities of a byte string, one position and one cell vector at a time."""
    p, W = net.p, langid.WIDTH
    states = {}
    for d in "fb":
        h, out = np.zeros(W), []
        for x in raw if d == "f" else raw[::-1]:
            a = p[f"W{d}"] @ p["E"][:, x] + p[f"b{d}"][:, 0]
            u = p[f"U{d}"] @ h
            r, z = (np.clip((a[i : i + W] + u[i : i + W]) / 4 + 0.5, 0, 1) for i in (0, W))
            new = np.clip(a[2 * W :] + r * (u[2 * W :] + p[f"c{d}"][:, 0]), -1, 1)
            h = z * h + (1 - z) * new
            out.append(h)
        states[d] = out if d == "f" else out[::-1]
    y = np.array([p["O"] @ np.concatenate([f, b]) + p["o"][:, 0] for f, b in zip(states["f"], states["b"], strict=True)])
    y = np.exp(y - y.max(1, keepdims=True))
    return y / y.sum(1, keepdims=True)


def test_languages_on_held_out_rows(tables):
    docs, _ = tables
    got = langid.languages(docs).join(docs.select("doc_id", "lang"), "doc_id")
    assert got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98


def test_languages_of_odd_rows(docs, corpus, none, monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 40)
    got = langid.languages(docs).collect()
    assert len(got) == len(corpus)
    texts = {r[0]: r[1] for r in corpus}
    for r in got:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id] or "")) and 0 <= r.score <= 1
    assert langid.languages(none).collect() == []
    assert {r.lang_pred for r in langid.languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_documents_pool_the_labels_of_all_positions():
    net = langid.Network(["a", "b", "c"])
    texts = ["läuft das? " * 3 + "x" * 60, "", "é", "ab cd " * 9, None]
    got = langid.Reader(net).probabilities(pa.array(texts, pa.string()))
    for text, row in zip(texts, got, strict=True):
        assert row == pytest.approx(by_hand(net, text.encode()).mean(0) if text else np.zeros(3), abs=1e-4)


def test_states_run_on_across_words_and_windows(monkeypatch):
    """A position's label depends on the word before it, and windows label as one pass over the text would, but for what lies far off."""
    net = langid.Network(["a", "b"]).learn(["le la un de " * 9, "the of and to " * 9], [0, 1])
    cells = lambda t: net.labels(np.frombuffer(t.encode(), np.uint8)[None].astype(np.int16))[:, :, 0]
    assert np.abs(cells("the on")[4:] - cells("une on")[4:]).max() > 1e-3
    text = "le la the of and un de to " * 40
    monkeypatch.setattr(langid, "CORE", 32)
    got = langid.Reader(net).probabilities(pa.array([text]))[0]
    assert got == pytest.approx(cells(text).mean(0), abs=0.02) and got.sum() == pytest.approx(1, abs=1e-4)


def test_every_language_is_learned(spark, monkeypatch):
    """More than a hundred languages, some of one document: each can be predicted."""
    monkeypatch.setattr(langid, "STEPS", 2)
    rows = [(i, f"text number {i} of many", f"l{i % 130:03}") for i in range(0, 4000)]
    net = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), total=500)
    assert len(net.langs) == 130
    got = langid.Reader(net).probabilities(pa.array(["some text"]))
    assert got.shape == (1, 130) and got.sum() == pytest.approx(1, abs=1e-3)


def test_an_id_of_very_many_texts_counts_once(spark, monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 1)
    seen = []
    monkeypatch.setattr(langid.Network, "learn", lambda self, texts, labels: seen.extend(texts) or self)
    rows = [(1, f"text {i}", "en") for i in range(500)] + [(3, "ein text", "de"), (4, "x" * 5000, "de")]
    langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most_bytes=1000)
    assert len(seen) <= 3 and "ein text" in seen and sum(map(len, seen)) <= 1000


def test_quality_learns_in_a_task_and_the_driver_holds_no_text(spark, monkeypatch):
    docs = spark.createDataFrame([(i, ("good words here " if i % 2 else "zq xx vv ") * (i % 5 + 3)) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    rows = common.labelled_sample(docs, labels, "quality", mod=5, rest=0, rows=quality.TRAIN_ROWS, seed=quality.SEED)
    train, driver = quality.train, os.getpid()
    own = train(rows)

    def elsewhere(rows):
        assert os.getpid() != driver
        return train(rows)

    monkeypatch.setattr(quality, "train", elsewhere)
    got = quality.fit(docs, labels)
    assert rows and got.bias == own.bias and (got.weight == own.weight).all()


def test_the_driver_collects_its_garbage_every_few_tables(spark):
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    full = lambda: sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())
    before = full()
    with common.Scratch(spark) as scratch:
        for i in range(common.Scratch.EVERY):
            scratch.table(spark.range(1), f"t{i}")
    assert full() > before
