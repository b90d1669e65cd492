"""Merkle manifest, toxicity and whitening, each against a brute-force version or held-out accuracy."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdure.llm import merkle, toxicity, whitening


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row.doc_id, row.source, row.lang, row.n_chars, text)))


def levels_over(level):
    out = [level]
    while len(level) > 1:
        level = [h("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
        out.append(level)
    return out


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        first = i // 3 * 3
        out.append(("".join(level[first:i]), "".join(level[i + 1 : first + 3])))
        i //= 3
    return out


def expected(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of every row, as sorted lists."""
    groups = {}
    for r in rows:
        groups.setdefault(r.source, []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        groups[s].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
        trees.append(levels_over([leaf_of(r, r.text) for r in groups[s]]))
    crown = levels_over([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(groups[s]):
            steps = siblings(trees[k], i) + siblings(crown, k)
            cut = r.text is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
            acc = leaf_of(r, r.text.replace("\n", "") if cut else r.text)
            for left, right in steps:
                acc = h(left + acc + right)
            out.append((r.doc_id, trees[k][0][i], trees[k][-1][0], crown[-1][0], h("".join(a + b for a, b in steps)), acc, acc == crown[-1][0]))
    return sorted(out, key=str)


def checked(docs):
    tampered = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    even = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    return merkle.tamper_check(docs, tampered, even)


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 3, None: 1}, {"b": 28, "a": 82, None: 4, "é": 9, "": 1}, {f"s{i:03}": 1 + i % 5 for i in range(40)}])
def test_manifest_equals_brute_force(spark, make_docs, sizes):
    rng, rows, i = random.Random(1), [], 0
    for source, count in sizes.items():
        for _ in range(count):
            text = rng.choice([None, "", "one\ntwo", "one", f"line {i}\n\n"])
            rows.append((i * 7 % 1001, text, rng.choice(["en", None]), source, rng.choice([None, 5])))
            i += 1
    rng.shuffle(rows)
    docs = make_docs(rows, clashing=True)
    got = sorted((tuple(r) for r in checked(docs).collect()), key=str)
    assert got == expected(docs.collect())


def test_manifest_of_repeated_rows_and_rows_without_id(make_docs, odd_texts):
    rows = [(None, t, "en", "hot", 1) for t in odd_texts] + [(5, "same\ntext", "en", "hot", 9)] * 11
    docs = make_docs(rows)
    assert sorted((tuple(r) for r in checked(docs).collect()), key=str) == expected(docs.collect())


def test_manifest_of_an_empty_table(make_docs):
    empty = make_docs([(1, "x")]).where("false")
    assert checked(empty).count() == 0
    assert merkle.manifest(empty).root is None and merkle.manifest(empty).nodes().count() == 0


def test_nodes_are_nested_intervals(make_docs):
    made = merkle.manifest(make_docs([(i, f"text {i}", "en", "src" if i % 3 else "other", 1) for i in range(200)]))
    for tree in {r.tree for r in made.nodes().select("tree").distinct().collect()}:
        nodes = [r for r in made.nodes().collect() if r.tree == tree]
        top = max(r.level for r in nodes)
        for r in nodes:
            assert 0 < r.hi - r.lo <= 3**r.level
            assert r.level == top or sum(p.level == r.level + 1 and p.lo <= r.lo and r.hi <= p.hi for p in nodes) == 1


def test_verify_finds_changed_and_missing_rows(make_docs):
    rows = [(i, f"text {i}", "en", f"src{i % 4}", 6) for i in range(120)]
    known = merkle.manifest(make_docs(rows))
    now = [r for r in rows if r[0] != 17]
    now[30] = (now[30][0], "changed", *now[30][2:])
    bad = {r.doc_id for r in merkle.verify(make_docs(now + [(500, "new", "en", "src1", 3)]), known).where("not verified").collect()}
    assert bad == {17, now[30][0]}


CLEAN = "river stone window garden letter market summer paper bridge music winter village table candle forest".split()
RUDE = ["grumblort", "snarfwit", "blighter"]


def sentences(rng, rude, misspell=False):
    words = rng.choices(CLEAN, k=rng.randint(15, 80))
    for _ in range(max(2, len(words) // 12) if rude else 0):
        w = rng.choice(RUDE)
        at = rng.randrange(len(w) - 1)
        words.insert(rng.randrange(len(words)), w[:at] + w[at] * 2 + w[at + 1 :] if misspell else w)
    return " ".join(words)


@pytest.fixture(scope="module")
def rude_docs(spark, make_docs):
    rng = random.Random(3)
    rows = [(i, sentences(rng, i % 5 == 0)) for i in range(400)]
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    return make_docs(rows), labels


def test_toxicity_held_out_and_misspelled(make_docs, rude_docs):
    docs, labels = rude_docs
    model = toxicity.train(docs.where("doc_id < 300"), labels)
    rng = random.Random(4)
    fresh = make_docs([(i, sentences(rng, i % 2 == 0, misspell=True)) for i in range(100)])
    for part in (docs.where("doc_id >= 300").withColumn("want", F.expr("int(doc_id % 5 = 0)")), fresh.withColumn("want", F.expr("int(doc_id % 2 = 0)"))):
        want = {r.doc_id: r.want for r in part.collect()}
        got = {r.doc_id: r.predicted for r in toxicity.scored(part, model, F.lit(True)).collect()}
        assert sum(got[i] == w for i, w in want.items()) >= 0.97 * len(want)


def test_toxicity_is_repeatable_and_ignores_other_columns(rude_docs):
    docs, labels = rude_docs
    once = {r.doc_id: r.score for r in toxicity.classify(docs, labels, F.col("doc_id") % 7 == 0).collect()}
    moved = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string")).repartition(5)
    again = {r.doc_id: r.score for r in toxicity.classify(moved, labels, F.col("doc_id") % 7 == 0).collect()}
    assert once == again and all(0 <= s <= 1 for s in once.values())


def test_toxicity_score_is_the_softmax_over_the_mean_vector(rude_docs):
    docs, labels = rude_docs
    model = toxicity.train(docs, labels)
    text = "Garden grumblort garden, river"
    weights = {"garden": math.log2(3), "grumblort": 1.0, "river": 1.0}
    z = sum(k * model.table[toxicity.subwords(w)].mean() for w, k in weights.items()) / (sum(weights.values()) + toxicity.BLANKS) + model.bias
    words = toxicity.words_of(text)
    got = model.score(words, dict(zip(sorted(set(words)), model.word_logits(sorted(set(words))), strict=True)))
    assert got == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-12)


def test_toxicity_of_odd_texts_and_missing_labels(spark, make_docs, odd_texts, rude_docs):
    labels = rude_docs[1]
    odd = make_docs([(i if i % 4 else None, t) for i, t in enumerate(odd_texts * 2)], clashing=True)
    one_kind = labels.withColumn("toxic", F.lit(0))
    nulls = spark.createDataFrame([(None, 1, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    for told, score in ((one_kind, 0.0), (nulls, 0.0), (labels.where("false"), 0.0)):
        rows = toxicity.classify(odd, told).collect()
        assert len(rows) == 2 * len(odd_texts) and all(r.score == score and r.predicted == 0 for r in rows)
    model = toxicity.train(rude_docs[0], labels)
    rows = toxicity.scored(odd, model, F.lit(False)).collect()
    assert len(rows) == 2 * len(odd_texts) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.classify(odd.where("false"), labels).count() == 0


def white_by_numpy(vectors):
    """{row: (component, n, deviation, whitened, explained)} of usable vectors of one length, in plain numpy."""
    x = np.floor(256 * np.asarray(vectors, dtype=np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1][:4]
    return n, [sum((n * int(v) - int(s)) ** 2 for v, s in zip(r, sums, strict=True)) for r in x], (x - sums / n) @ directions[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(2)
    base = (rng.normal(size=(3000, 12)) * np.linspace(0.2, 1.5, 12)).astype(np.float32)
    base[1000:2000] = base[7]
    rows = [(i, [float(v) for v in base[i]], 0) for i in range(len(base))]
    rows += [(9001, None, 1), (9002, [1.0, None] + [0.0] * 10, 1), (9003, [math.nan] * 12, 1), (9004, [math.inf] * 12, 1), (9005, [], 1)]
    got = whitening.whiten(vectors_of(spark, rows).repartition(7)).collect()
    n, deviation, white, explained = white_by_numpy(base)
    assert len(got) == 4 * len(base) and {r.n for r in got} == {n} and n == 2000
    assert max(r.identity_error for r in got) < 1e-8
    out = np.zeros((len(base), 4))
    for r in got:
        assert r.deviation == deviation[r.vec_id]
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        out[r.vec_id, r.component - 1] = r.whitened
    signs = np.sign((out * white).sum(axis=0))
    assert np.abs(out - white * signs).max() < 1e-8


def test_whitening_of_little_or_odd_input(spark):
    assert whitening.whiten(vectors_of(spark, [(1, [1.0, 2.0], 0)] * 3)).count() == 0
    assert whitening.whiten(vectors_of(spark, [(1, None, 0)])).count() == 0
    line = [(i, [float(i), 2.0 * i, 0.0], 0) for i in range(5)] + [(None, [0.0, 0.0, 0.0], 0)]
    got = whitening.whiten(vectors_of(spark, line).withColumn("x", F.lit("x")).withColumn("idx", F.lit(1)))
    assert {r.component for r in got.collect()} == {1} and got.count() == 6
    mixed = line + [(100 + i, [float(i % 3), float(i * i)], 0) for i in range(6)]
    assert {(r.vec_id, r.component) for r in whitening.whiten(vectors_of(spark, mixed)).where("vec_id >= 100").collect()} == {(100 + i, c) for i in range(6) for c in (1, 2)}
    huge = spark.createDataFrame([(i, [1e300 * (i - 1), float(i)]) for i in range(3)], "vec_id long, embedding array<double>")
    rows = whitening.whiten(huge).collect()
    assert {r.vec_id for r in rows} == {0, 1, 2} and any(r.deviation is None for r in rows)
