import re

import numpy as np
import pyarrow as pa
import pytest

from fragstream.llm import minhash


def shingles(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(rows):
    """(doc_id -> smallest id of its component), by all pairs; rows with a null id, by their place, link as well."""
    keys = [r[0] if r[0] is not None else 10**9 + at for at, r in enumerate(rows)]
    ids = sorted(set(keys))
    sets, up = {i: [] for i in ids}, {i: i for i in ids}
    for i, r in zip(keys, rows, strict=True):
        sets[i].append(shingles(r[1]))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in ids:
        for j in ids:
            if i < j and any(a and b and 100 * len(a & b) >= 75 * len(a | b) for a in sets[i] for b in sets[j]):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return {i: top(i) for i in ids if i < 10**9}


def test_classes_equal_brute_force(docs, corpus):
    got = minhash.near_duplicate_classes(docs).collect()
    assert len(got) == len(corpus)
    expected = brute(corpus)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept and r.n_shingles == 4
        else:
            assert r.component_id == expected[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    sizes = {(r.doc_id, r.n_shingles) for r in got}
    assert sizes == {(r[0], len(shingles(r[1]))) for r in corpus}


def test_loose_chain_is_found_through_its_middle(spark):
    """Copies that are close to one original only: stragglers are compared with all others of their buckets."""
    rng = np.random.default_rng(3)
    base = [f"w{x}" for x in rng.integers(0, 9999, 60)]
    rows = [(1000, " ".join(base))]
    for i in range(80):
        w = list(base)
        for at in rng.choice(60, 2, replace=False):
            w[at] = f"x{i}{at}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute([(a, b) for a, b in rows])


def test_every_text_of_an_id_counts(spark):
    """Rows that share an id and hold different texts: what links either of them links the id, and a row without an id can be the middle."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(5, a), (5, b), (6, a + " more"), (7, b + " more"), (8, "x y z"), (8, None), (9, ""), (20, c), (None, c), (None, c + " 1"), (21, c + " 1 2"), (30, d), (30, d), (31, d.upper())]
    df = spark.createDataFrame(rows, "`doc id` long, text string").repartition(3)
    got = minhash.near_duplicate_classes(df, id_col="doc id")
    assert got.columns == ["doc id", "n_shingles", "component_id", "kept"]
    own = [(r[0], r.component_id, r.kept) for r in got.collect()]
    expected = brute(rows)
    assert expected[7] == 5 and expected[21] == 20
    assert sorted((i, c) for i, c, _ in own if i is not None) == sorted((i, expected[i]) for i, _ in rows if i is not None)
    assert [x for x in own if x[0] is None] == [(None, 20, False)] * 2 and all(k == (i == c) for i, c, k in own)


def test_an_id_with_very_many_texts(spark):
    rows = [(7, f"only text {i} of one id") for i in range(300)] + [(3, "only text 250 of one id"), (1, "else")]
    got = {(r.doc_id, r.component_id) for r in minhash.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(7, 3), (3, 3), (1, 1)}


def test_a_tile_gives_fewer_links_than_it_has_components():
    """Forty near copies, each a component of its own, all linked with all: a tile joins them by 39 links, and leaves out what is no link."""
    import pandas as pd

    base = np.arange(1000, dtype=np.uint64) * np.uint64(1 << 40)
    sets = [np.sort(np.append(base[: 960 + i], np.uint64(i + 1))) for i in range(40)] + [base[:749], np.arange(9, dtype=np.uint64)]
    rows = [(role, i, i, x.tobytes()) for i, x in enumerate(sets) for role in (0, 1) if role or i]
    got = minhash._tile(pd.DataFrame(rows, columns=["role", "id", "comp", "shingles"])).to_numpy().tolist()
    near = {(a, b) for a in range(42) for b in range(a + 1, 42) if 100 * len(c := np.intersect1d(sets[a], sets[b])) >= 75 * (len(sets[a]) + len(sets[b]) - len(c))}
    up = list(range(42))
    for a, b in got:
        assert (a, b) in near and up[a] != up[b]
        up = [up[a] if x == up[b] else x for x in up]
    assert all(up[a] == up[b] for a, b in near) and up[41] != up[0]


def test_no_rows(none):
    assert minhash.near_duplicate_classes(none).collect() == []


def test_min_and_max_both_estimate_the_similarity():
    all_ = np.random.default_rng(1).integers(0, 2**64, 4000, dtype=np.uint64)
    a, b = all_[:3000], all_[1000:]  # 2000 of 4000 are in both
    same = minhash.signature(a) == minhash.signature(b)
    assert abs(same[: minhash.PERMS].mean() - 0.5) < 0.12 and abs(same[minhash.PERMS :].mean() - 0.5) < 0.12
    assert sorted(minhash.SLOTS.ravel()) == list(range(2 * minhash.PERMS))
    assert all(len(set(band % minhash.PERMS)) == minhash.ROWS for band in minhash.SLOTS)  # no permutation twice in a band


@pytest.mark.parametrize("text", ["", "a", "a b c d e f", "É é É é é é", "x" * 500 + " y"])
def test_sets_and_digests(text):
    (found, digest), (again, same) = minhash.shingle_sets(pa.array([text, f" {text.replace('x', 'X')}\n"]))
    assert len(found) == len(shingles(text)) and (found == again).all() and digest == same and bool(digest) == bool(text)
