import hashlib
import random
import re

import pytest

from fragstream.llm import common, decontaminate

from .conftest import prose

ITEMS = "item_id long, text string, extra string"


def words(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        b = words(t)
        n = min(13, len(b))
        grams = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if n else set()
        for i in range(len(w) - n + 1) if n else ():
            if tuple(w[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                found |= {item} - {None}
    ids = sorted(map(str, found))
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


def rows():
    rng = random.Random(11)
    items = [(i, prose(rng, rng.choice((13, 20, 40)))) for i in range(8)] + [(100, "Zwölf KURZE wörter!"), (9, "solo"), (10, None), (11, "..."), (12, ""), (None, prose(rng, 15)), (3, prose(rng, 14)), (20, "É und é")]
    docs = []
    for k in range(60):
        w = prose(rng, rng.choice((0, 5, 30, 300))).split()
        for _ in range(rng.choice((0, 1, 1, 2))):
            b = (rng.choice(items)[1] or "").split()
            cut = b[rng.randrange(3) :] if rng.random() < 0.5 else b
            w[(at := rng.randrange(len(w) + 1)) : at] = [x.upper() if rng.random() < 0.3 else x + rng.choice(("", ",", "!?")) for x in cut]
        docs.append((k, " ".join(w)))
    return docs + [(70, None), (71, ""), (None, items[0][1]), (5, items[1][1]), (5, items[1][1]), (72, "é UND É"), (73, prose(rng, 20000) + " " + items[2][1]), (74, items[2][1] * 50)], items


@pytest.mark.parametrize("most", [2_000_000, 40])
def test_results_equal_brute_force(spark, monkeypatch, most):
    """With all windows in one broadcast, and with a benchmark of several blocks."""
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", most)
    monkeypatch.setattr(common, "BROADCAST_BYTES", most)
    docs, items = rows()
    df = spark.createDataFrame([(a, b, "x", 1) for a, b in docs], "doc_id long, text string, key string, copy int").repartition(3)
    got = decontaminate.contamination(df, spark.createDataFrame([(a, b, "y") for a, b in items], ITEMS)).collect()
    own = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got)
    assert own == sorted((str(d), *brute(t, items)) for d, t in docs)
    assert any(r.contaminated for r in got) and any(r.n_hit and not r.contaminated for r in got)


def test_capital_sigma_beside_separators_equals_brute_force(spark):
    """Lower-cased by Unicode, the end of a word depends on '.', ':' and apostrophe, which are no part of it."""
    text = "Α.Σ. ΤΟ ΟΔΟΣ.ΑΒ ΟΔΟΣ'Α ΟΔΟΣ:Α"
    items = [(1, text), (2, "ΟΔΟΣ"), (3, "ΤΟ ΟΔΟΣ ΑΒ"), (4, "İ ǅ K"), (5, "το οδος")]
    docs = [(i, t) for i, t in enumerate([text, f"x {text} y", "ΤΟ ΟΔΟΣ.ΑΒ", "ΟΔΟΣ:Α", "ΟΔΟΣ", "οδος", "το οδοσ", "İ'ǅ.K", "i̇ ǆ k"])]
    got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(*x, "") for x in items], ITEMS)).collect()
    own = sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got)
    assert own == sorted((d, *brute(t, items)) for d, t in docs) and own[0][2] == own[0][1]


def test_documents_and_spans_are_removed(spark):
    docs, items = rows()
    df = spark.createDataFrame([(a, b, "x", 1) for a, b in docs], "doc_id long, text string, key string, copy int")
    bench = spark.createDataFrame([(a, b, "y") for a, b in items], ITEMS)
    kept = sorted(str(r.doc_id) for r in decontaminate.decontaminate(df, bench).collect())
    assert kept == sorted(str(d) for d, t in docs if not brute(t, items)[4])
    cut = decontaminate.decontaminate(df, bench, remove="spans")
    assert cut.columns == df.columns and cut.count() == len(docs)
    before = {d: t for d, t in docs if d not in (None, 5)}
    for r in cut.where("doc_id is not null and doc_id <> 5").collect():
        n, hit, *_ = brute(before[r.doc_id], items)
        assert len(words(r.text)) == n - hit
        if not hit:
            assert r.text == before[r.doc_id]


def test_nothing_to_find(spark, docs, none):
    empty = spark.createDataFrame([], ITEMS)
    assert decontaminate.contamination(docs, empty).where("contaminated or n_hit > 0").count() == 0
    assert decontaminate.contamination(none, empty).collect() == []
    assert decontaminate.decontaminate(docs, empty).count() == docs.count()
    assert decontaminate.contamination(none, spark.createDataFrame([(1, "a b c", "")], ITEMS)).collect() == []
