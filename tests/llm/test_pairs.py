"""Similarity joins and searches against brute force."""

import random
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdure import session
from verdure.llm import jaccard, neardup, topk
from verdure.llm.vectors import choose_pivots

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def components(n, linked):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return [root(i) for i in range(n)]


def by_shingles(rows):
    sets = [shingles(t) for _, t in rows]
    roots = components(len(rows), lambda a, b: bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]))
    least = {}
    for r, (i, _) in zip(roots, rows, strict=True):
        least[r] = min((x for x in (i, least.get(r)) if x is not None), default=None)
    return sorted((str(i), len(s), str(least[r])) for (i, _), s, r in zip(rows, sets, roots, strict=True))


def near_copies(seed, groups=12, copies=9):
    """Groups around the threshold, a passage that all share, chains and copies of copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=60)
    texts = []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.randint(4, 120)) + (passage if rng.random() < 0.6 else [])
        now = base
        for _ in range(rng.randint(1, copies)):
            now = list(now if rng.random() < 0.5 else base)
            for _ in range(rng.randint(0, max(1, len(now) // 18))):
                now[rng.randrange(len(now))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                now = now[: max(1, int(len(now) * rng.uniform(0.7, 1)))]
            texts.append(" ".join(w.upper() if rng.random() < 0.1 else w for w in now))
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_jaccard_components(make_docs, odd_texts, seed):
    texts = near_copies(seed) + odd_texts + ["a b c", "A b  c", "a b c d", "x" * 10]
    rng = random.Random(seed)
    rows = list(zip(rng.sample(range(10_000), len(texts)), texts, strict=True))
    got = jaccard.jaccard_components(make_docs(rows, clashing=True)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == by_shingles(rows)


def test_a_large_group_of_near_copies(make_docs):
    """A list much longer than a block, with members that link with few others."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(300):
        words = list(base)
        for k in rng.sample(range(80), rng.choice([0, 1, 1, 2, 3])):
            words[k] = f"v{rng.randrange(10_000)}"
        rows.append((i, " ".join(words)))
    got = jaccard.jaccard_components(make_docs(rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == by_shingles(rows)


def one_group(count, seed):
    """One group of near copies, most of whose pairs lie below the limit: copies of a text with some words changed."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(count):
        words = list(base)
        for at in rng.sample(range(150), rng.choice([1, 2, 3, 4])):
            words[at] = rng.choice(["alpha", "beta", "gamma", "delta"])
        rows.append((i, " ".join(words)))
    return rows


def test_compared_pairs_grow_with_a_group_not_with_its_square(make_docs, monkeypatch):
    compared = {}
    for count in (400, 800, 1600):
        written = []
        real = jaccard.materialize
        monkeypatch.setattr(jaccard, "materialize", lambda df, label, real=real, written=written: (out := real(df, label), written.append((label, out)))[0])
        rows = one_group(count, 5)
        got = jaccard.jaccard_components(make_docs(rows)).collect()
        monkeypatch.setattr(jaccard, "materialize", real)
        assert len(got) == count
        compared[count] = sum(df.count() for label, df in written if label in ("shingle-answers", "shingle-rest"))
        if count == 400:
            assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == by_shingles(rows)
    print(compared)
    assert compared[1600] <= 5 * compared[400] and compared[800] <= 2.5 * compared[400]


def test_last_leaders_with_few_pairs_are_not_followed_by_more(make_docs, monkeypatch):
    """The rounds that are left out change no component."""
    rounds, rows = {}, one_group(400, 5)
    for few in (0, jaccard.FEW_PAIRS):
        written = []
        real = jaccard.materialize
        monkeypatch.setattr(jaccard, "FEW_PAIRS", few)
        monkeypatch.setattr(jaccard, "materialize", lambda df, label, real=real, written=written: (written.append(label), real(df, label))[1])
        got = jaccard.jaccard_components(make_docs(rows)).collect()
        monkeypatch.setattr(jaccard, "materialize", real)
        assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == by_shingles(rows)
        rounds[few] = written.count("shingle-leaders")
    print(rounds)
    assert rounds[100] < rounds[0]


def test_jaccard_rows_without_id_or_repeated(make_docs):
    text = "one two three four five six seven"
    rows = [(5, text), (5, text), (None, text), (3, "other words than those before this"), (3, text), (None, "lonely words that nobody else has"), (8, None), (8, "")]
    got = jaccard.jaccard_components(make_docs(rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == by_shingles(rows)
    kept = jaccard.one_per_component(make_docs(rows, clashing=True))
    assert kept.columns == make_docs(rows, clashing=True).columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted(
        [("3", "other words than those before this"), ("3", text), ("None", "lonely words that nobody else has"), ("8", "None"), ("8", "")]
    )
    assert jaccard.jaccard_components(make_docs(rows).limit(0)).count() == 0
    assert jaccard.one_per_component(make_docs(rows).limit(0)).count() == 0


def test_one_per_component_keeps_the_smallest_id(make_docs):
    rows = list(enumerate(near_copies(7)))
    want = {int(c) for _, _, c in by_shingles(rows)}
    assert {r.doc_id for r in jaccard.one_per_component(make_docs(rows, clashing=True)).collect()} == want


def test_one_per_component_leaves_no_table_that_nobody_reads(spark, make_docs, monkeypatch):
    made = []
    real = session.scratch_path
    monkeypatch.setattr(session, "scratch_path", lambda spark, label: (path := real(spark, label), made.append(path))[0])
    rows = list(enumerate(near_copies(7)))
    for given in (rows, [*rows, rows[0], (None, "words without an id")]):
        made.clear()
        kept = jaccard.one_per_component(make_docs(given))
        left = [Path(p.removeprefix("file:")).name.rsplit("-", 1)[0] for p in made if Path(p.removeprefix("file:")).exists()]
        assert len(made) > 8 and sorted(left) in (["shingle-removed"], ["numbered", "numbers", "shingle-removed"])
        want = {int(c) for _, _, c in by_shingles(rows)}
        assert {r.doc_id for r in kept.collect()} - {None} == want


def test_shingle_hashes_do_not_cross_texts():
    h, limits = jaccard.shingle_hashes(["a b c d e f", "", "x y", "a b c d e", "X y", "b c d e f g"])
    sets = [set(h[a:b].tolist()) for a, b in zip(limits[:-1], limits[1:], strict=True)]
    assert [len(s) for s in sets] == [2, 0, 1, 1, 1, 2]
    assert sets[3] < sets[0] and sets[2] == sets[4] and len(sets[0] & sets[5]) == 1


def vectors(spark, rows):
    df = spark.createDataFrame([(i, [float(x) if x is not None else None for x in v] if v is not None else None) for i, v in rows], "vec_id long, embedding array<float>")
    for name in ("cid", "w", "key", "x", "uid", "pivot", "rank", "links"):
        df = df.withColumn(name, F.lit(1))
    return df.repartition(3)


ODD_VECTORS = [
    (9001, None), (9002, []), (9003, [0.0] * 16), (9004, [None] + [1.0] * 15), (9005, [float("nan")] * 16), (9006, [float("inf")] + [1.0] * 15),
    (9050, None), (9100, [float("-inf")] * 16), (9008, [1.0, 2.0]), (9009, [2.0, 4.0]), (9010, [-0.0, 1.0]), (9011, [0.0, 1.0]),
]


def crowd(seed, groups=25, size=12, dim=16):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(groups):
        center = rng.standard_normal(dim)
        for _ in range(rng.integers(1, size)):
            out.append(center + rng.standard_normal(dim) * rng.choice([0, 0.05, 0.2]))
    return [v.astype(np.float32) for v in out]


def test_near_duplicates(spark):
    rows = list(enumerate(crowd(1))) + ODD_VECTORS
    found = {r.vec_id: r for r in neardup.near_duplicates(vectors(spark, rows), block=16).collect()}
    good = []
    for i, v in rows:
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.append((i, np.asarray(v, np.float32).astype(float)))

    def linked(a, b):
        x, y = good[a][1], good[b][1]
        return len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.95

    roots = components(len(good), linked)
    links = [sum(linked(a, b) for b in range(len(good)) if b != a) for a in range(len(good))]
    ids = [i for i, _ in good]
    assert len(found) == len(rows)
    missed = 0
    for k, i in enumerate(ids):
        least = min(ids[j] for j in range(len(ids)) if roots[j] == roots[k])
        missed += links[k] - found[i].n_links
        assert found[i].n_links <= links[k]
        assert found[i].component_id == least and found[i].kept == (i == least), i
    assert missed <= 0.02 * sum(links)
    for i in {i for i, _ in rows} - set(ids):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True)


def test_recall_at_the_threshold():
    """Pairs at a cosine of exactly 0.95 in 64 dimensions share enough of 200 pivots."""
    rng = np.random.default_rng(3)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    pivots, u = unit(rng.standard_normal((200, 64))), unit(rng.standard_normal((3000, 64)))
    w = rng.standard_normal(u.shape)
    w = unit(w - (w * u).sum(axis=1, keepdims=True) * u)
    v = 0.95 * u + (1 - 0.95**2) ** 0.5 * w
    a, b = neardup.permutations(u, pivots), neardup.permutations(v, pivots)
    shared = (a[:, :, None] == b[:, None, :]).any(axis=2).sum(axis=1)
    assert (shared >= neardup.SHARED).mean() >= 0.98


def test_copies_and_missing_ids(spark):
    rows = [(i, [1.0, 0.0, 0.5]) for i in range(40)] + [(7, [1.0, 0.0, 0.5]), (None, [1.0, 0.0, 0.5]), (None, [0.0, 1.0, 0.0]), (90, [2.0, 0.0, 1.0])]
    got = neardup.near_duplicates(vectors(spark, rows)).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == sorted(
        [(str(i), 42, "0", i == 0) for i in [*range(40), 7, 90]] + [("None", 42, "0", False), ("None", 0, "None", False)]
    )
    assert neardup.near_duplicates(vectors(spark, rows).limit(0)).count() == 0
    assert neardup.near_duplicates(vectors(spark, ODD_VECTORS[:4])).count() == 4


def test_pivots_are_spread(spark):
    rng = np.random.default_rng(2)
    rows = [(i, list(rng.standard_normal(8))) for i in range(60)] + [(100 + i, [1.0] * 7 + [1 + i * 1e-4]) for i in range(60)]
    chosen = choose_pivots(vectors(spark, rows).select("embedding"), 20, unit=True)
    assert (np.abs(chosen[:, :7] - chosen[:, :1]).max(axis=1) < 0.05).sum() <= 1


def best(rows, every, k):
    given = []
    for i, v in rows:
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v):
            given.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    out = []
    for a, (i, q) in enumerate(given):
        if i is not None and i % every == 0:
            scored = [(-sum(map(int.__mul__, q, x)), j is None, j or 0, b) for b, (j, x) in enumerate(given) if b != a and len(x) == len(q)]
            out += [(i, r + 1, None if n else j, -s) for r, (s, n, j, _) in enumerate(sorted(scored)[:k])]
    return sorted(map(str, out))


@pytest.mark.parametrize("ring, block", [(512, 1024), (7, 3)])
def test_top_products(spark, ring, block):
    rows = list(enumerate(crowd(4, 40))) + ODD_VECTORS + [(50, [0.5] * 16), (None, [0.5] * 16)]
    got = topk.top_products(vectors(spark, rows), 10, 5, ring, block).collect()
    assert sorted(str((r.query_id, r.rank, r.vec_id, r.score)) for r in got) == best(rows, 10, 5)


def test_top_products_with_ties_few_and_large(spark):
    copies = [(i, [1.0, -1.0, 0.25]) for i in range(120)]
    assert sorted(str((r.query_id, r.rank, r.vec_id, r.score)) for r in topk.top_products(vectors(spark, copies), ring=16).collect()) == best(copies, 50, 5)
    few = [(0, [1.0, 2.0]), (1, [3.0, -1.0]), (50, [3e6, 4e6]), (51, [5e6, 4e6])]
    assert sorted(str((r.query_id, r.rank, r.vec_id, r.score)) for r in topk.top_products(vectors(spark, few)).collect()) == best(few, 50, 5)
    assert topk.top_products(vectors(spark, few).limit(0)).count() == 0
    assert topk.top_products(vectors(spark, [(0, None)])).count() == 0
