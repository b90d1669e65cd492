from collections import deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdure.operators import aoi, clustering, components, neighbors
from verdure.operators.components import connected_components
from verdure.operators.ranking import exact_quantile, global_rank, order_key
from verdure.operators.skew import measured_salts, salted_lookup


def table(spark, pts):
    rows = [(int(i), float(x), float(y)) for i, (x, y) in enumerate(np.round(pts, 3))]
    return spark.createDataFrame(rows, "ord long, x double, y double")


def distances(pts):
    pts = np.round(pts, 3)
    d = pts[:, None] - pts[None]
    return np.sqrt(d[..., 0] ** 2 + d[..., 1] ** 2)


def brute_dbscan(pts, eps, min_samples):
    near = distances(pts) <= eps
    core = near.sum(1) >= min_samples
    label, count = np.full(len(pts), -1), 0
    for start in range(len(pts)):
        if label[start] != -1 or not core[start]:
            continue
        label[start], queue = count, deque([start])
        while queue:
            u = queue.popleft()
            if core[u]:
                for v in np.flatnonzero(near[u]):
                    if label[v] == -1:
                        label[v] = count
                        queue.append(v)
        count += 1
    return label


def labels(df):
    return {r["ord"]: r["label"] for r in df.collect()}


rng = np.random.default_rng(7)
CLOUDS = {
    "even": rng.uniform(0, 1e5, (250, 2)),
    # a third of all points within a few metres, some of them copies
    "hot": np.vstack(
        [rng.normal(5e4, 4, (80, 2)), np.tile([[5e4, 5e4]], (40, 1)), rng.uniform(0, 1e5, (200, 2))]
    ),
    "copies": np.repeat(rng.uniform(0, 3e4, (40, 2)), 3, axis=0),
}


@pytest.mark.parametrize("name", CLOUDS)
def test_nearest_distance_equals_brute_force(spark, name):
    pts = CLOUDS[name]
    d = distances(pts)
    np.fill_diagonal(d, np.inf)
    got = dict(neighbors.nearest_distance(table(spark, pts)).collect())
    assert [got[i] for i in range(len(pts))] == pytest.approx(list(d.min(1)), abs=1e-9)


def test_nearest_distance_splits_full_cells(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "LEAF_SITES", 2)
    test_nearest_distance_equals_brute_force(spark, "hot")


def crowd_and_loners(crowd):
    """A crowd within 100 m, points at its rim, and far ones that see it across empty land."""
    gen = np.random.default_rng(crowd)
    rim = [(-30.0, 50.0), (50.0, -400.0), (130.0, 130.0)]
    far = [(90_000.0, 50.0), (-70_000.0, -65_000.0), (50.0, 120_000.0), (300_000.0, 299_000.0)]
    return np.vstack([gen.uniform(0, 100, (crowd, 2)).round(3), rim, far])


@pytest.mark.parametrize("crowd", [400, 1600, 6400])
def test_far_points_read_few_of_a_crowd(spark, crowd):
    """The sites that a probe reads on its way do not grow with the crowd that it looks at."""
    pts = crowd_and_loners(crowd)
    loners = pts[crowd:]
    want = [np.sort(np.hypot(*(pts - p).T))[1] for p in loners]
    sites = table(spark, pts).select("x", "y", F.lit(1).alias("copies"))
    width, height = np.ptp(pts, axis=0)
    settled, _, levels = neighbors._start_levels(sites, len(pts), width, height)
    settled = settled.cache()
    rungs = neighbors._rungs(levels, max(width, height))
    probes = spark.createDataFrame([(*map(float, p), None) for p in loners], "x double, y double, nn_dist double")
    got = neighbors.nearest_in_tree(probes, settled, neighbors.cell_tree(settled, rungs), rungs).collect()
    settled.unpersist()
    found = {(r["x"], r["y"]): r for r in got}
    assert [found[tuple(p)]["nn_dist"] for p in loners] == pytest.approx(want, abs=1e-9)
    assert max(r["read"] for r in got) <= 6 * neighbors.LEAF_SITES


def test_no_probe_meets_a_crowded_cell(spark, monkeypatch):
    """Rows out of the search of blocks: crowded cells answer with one box, whatever is in them."""
    pts = crowd_and_loners(3000)
    d = np.array([np.sort(np.hypot(*(pts - p).T))[1] for p in pts])
    got = dict(neighbors.nearest_distance(table(spark, pts)).collect())
    assert [got[i] for i in range(len(pts))] == pytest.approx(list(d), abs=1e-9)
    monkeypatch.setattr(neighbors, "LEAF_SITES", 3)
    some = np.vstack([pts[:200], pts[3000:]])
    want = [np.sort(np.hypot(*(some - p).T))[1] for p in some]
    got = dict(neighbors.nearest_distance(table(spark, some)).collect())
    assert [got[i] for i in range(len(some))] == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("seed", range(2))
def test_tree_agrees_from_any_probe(spark, seed):
    """Every site looked up in the tree alone, over negative and positive coordinates and several scales."""
    gen = np.random.default_rng(seed)
    scales = 10.0 ** gen.uniform(-1, 5, 250)
    pts = np.unique((gen.normal(0, 1, (250, 2)) * scales[:, None]).round(3), axis=0)
    sites = table(spark, pts).select("x", "y", F.lit(1).alias("copies"))
    width, height = np.ptp(pts, axis=0)
    settled, _, levels = neighbors._start_levels(sites, len(pts), width, height)
    rungs = neighbors._rungs(levels, max(width, height))
    probes = sites.select("x", "y", F.lit(None).cast("double").alias("nn_dist"))
    got = neighbors.nearest_in_tree(probes, settled, neighbors.cell_tree(settled, rungs), rungs)
    found = {(r["x"], r["y"]): r["nn_dist"] for r in got.collect()}
    want = {tuple(p): np.sort(np.hypot(*(pts - p).T))[1] for p in pts}
    assert found.keys() == want.keys()
    assert all(found[p] == pytest.approx(want[p], abs=1e-9) for p in want)


def test_few_points_need_the_tree(spark, monkeypatch):
    """Most are final after the search of their block; only loners and those near a crowded cell go on."""
    asked = []
    inner = neighbors.nearest_in_tree
    monkeypatch.setattr(neighbors, "nearest_in_tree", lambda probes, *rest: asked.append(probes.count()) or inner(probes, *rest))
    rng = np.random.default_rng(5)
    pts = np.vstack([rng.uniform(0, 1e5, (1000, 2)), [[5e5, 5e5]]])
    plan = neighbors.nearest_distance(table(spark, pts))._jdf.queryExecution().executedPlan().toString()
    assert sum(asked) <= len(pts) // 10
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_one_point_and_no_points(spark):
    lone = table(spark, np.array([[1.0, 2.0]]))
    assert neighbors.nearest_distance(lone).collect() == [(0, None)]
    assert [tuple(r) for r in clustering.dbscan(lone, 1000.0, 2).collect()] == [(0, -1, 0)]
    none = lone.limit(0)
    assert neighbors.nearest_distance(none).collect() == []
    assert aoi.cluster_fields(none).collect() == []
    twins = table(spark, np.array([[1.0, 2.0], [1.0, 2.0]]))
    assert sorted(neighbors.nearest_distance(twins).collect()) == [(0, 0.0), (1, 0.0)]


@pytest.mark.parametrize(
    "name, eps, min_samples",
    [("even", 9000.0, 5), ("hot", 3.0, 3), ("copies", 2500.0, 4)],
)
def test_dbscan_equals_brute_force(spark, name, eps, min_samples):
    pts = CLOUDS[name]
    got = labels(clustering.dbscan(table(spark, pts), eps, min_samples))
    assert [got[i] for i in range(len(pts))] == list(brute_dbscan(pts, eps, min_samples))


@pytest.mark.parametrize("gap", [100.0, 100.1])
def test_full_cells_are_narrowed_down(spark, monkeypatch, gap):
    """Two crowded columns of points whose nearest distance is about eps."""
    monkeypatch.setattr(clustering, "DIRECT_PAIRS", 3)
    ys = np.linspace(0, 50, 20)
    pts = np.vstack([np.c_[np.full(20, 35.0), ys], np.c_[np.full(20, 35.0 + gap), ys]])
    got = labels(clustering.dbscan(table(spark, pts), 100.0, 3))
    assert [got[i] for i in range(40)] == list(brute_dbscan(pts, 100.0, 3))
    assert len(set(got.values())) == (1 if gap <= 100.0 else 2)


def test_narrowing_agrees_on_random_crowds(spark, monkeypatch):
    monkeypatch.setattr(clustering, "DIRECT_PAIRS", 2)
    gen = np.random.default_rng(3)
    pts = np.vstack([gen.normal(c, 25, (40, 2)) for c in ([0, 0], [160, 0], [160, 190], [600, 600])])
    got = labels(clustering.dbscan(table(spark, pts), 110.0, 4))
    assert [got[i] for i in range(len(pts))] == list(brute_dbscan(pts, 110.0, 4))


def test_noise_numbers_and_all_noise(spark):
    df = spark.createDataFrame([(0, None), (1, 1), (2, None), (3, 3), (4, 1)], "ord long, root long")
    got = {r["ord"]: (r["label"], r["cluster"]) for r in clustering.number_clusters(df).collect()}
    assert got == {0: (-1, 2), 1: (0, 0), 2: (-1, 3), 3: (1, 1), 4: (0, 0)}
    lost = clustering.number_clusters(df.where("root is null")).collect()
    assert {(r["label"], r["cluster"]) for r in lost} == {(-1, 0)}


def test_radius_pairs_include_the_limit(spark):
    pts = table(spark, np.array([[0.0, 0.0], [3.0, 4.0], [3.0, 4.001], [-5.0, 0.0]]))
    got = {(r["a"], r["b"]) for r in neighbors.radius_pairs(pts, 5.0).collect()}
    assert got == {(0, 1), (1, 2), (0, 3)}


def test_components_of_chain_star_and_ring(spark):
    chain = [(i, i + 1) for i in range(150)]
    star = [(1000, 1001 + i) for i in range(200)]
    ring = [(5000 + i, 5000 + (i + 1) % 9) for i in range(9)]
    edges = spark.createDataFrame([*chain, *star, *ring, (7, 7)], "a long, b long")
    got = {}
    for node, component in connected_components(edges).collect():
        got.setdefault(component, set()).add(node)
    want = [set(range(151)), {1000} | set(range(1001, 1201)), set(range(5000, 5009))]
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want))
    assert connected_components(edges.limit(0)).collect() == []


def test_components_of_a_large_star_take_two_rounds(spark, monkeypatch):
    written = []
    real = components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, label: (written.append(label), real(df, label))[1])
    star = spark.range(1, 3001).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    got = connected_components(star).collect()
    assert len(got) == 3001 and len({r["component"] for r in got}) == 1
    assert written.count("chosen") <= 2


@pytest.mark.parametrize("n", [1, 2, 101])
def test_exact_quantile_equals_numpy(spark, n):
    values = np.random.default_rng(n).integers(0, 9, n) * 0.37
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    for q in (0.5, 0.9):
        assert exact_quantile(df, "v", q).first()[0] == pytest.approx(np.quantile(values, q), abs=1e-12)


@pytest.mark.parametrize("q", [0.0, 0.37, 0.9, 1.0])
def test_quantiles_of_odd_numbers(spark, q):
    tiny, huge = 5e-324, 1.7e308
    some = [0.0, -0.0, tiny, 3 * tiny, 2.2e-308, 1e-300, 0.1, 0.5, 1.0, np.nextafter(1, 0), np.nextafter(1, 2), 2.0, 3.0, 8.0, 1e16, huge / 2, -1.0, -8.0, -tiny, -1e200] * 3
    df = spark.createDataFrame([(float(v),) for v in some] + [(None,)], "v double")
    want = np.sort(some)
    at = (len(some) - 1) * q
    lo, hi = want[int(at)], want[min(int(at) + 1, len(some) - 1)]
    assert exact_quantile(df, "v", q).first()[0] == lo + (hi - lo) * (at - int(at))


def test_order_keys_follow_the_numbers(spark):
    rng = np.random.default_rng(3)
    values = np.unique(np.concatenate([rng.normal(size=500) * 10.0 ** rng.integers(-320, 300, 500), 2.0 ** np.arange(-1074, 1023, 7), np.nextafter(2.0 ** np.arange(-60, 60), 0)]))
    rows = spark.createDataFrame([(float(v),) for v in values], "v double").select("v", order_key(F.col("v")).alias("k")).orderBy("v").collect()
    assert all(a["k"] < b["k"] for a, b in zip(rows, rows[1:], strict=False))


def test_quantile_needs_no_range_shuffle(spark):
    plan = exact_quantile(spark.range(1000).select(F.col("id").cast("double").alias("v")), "v", 0.9)._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan and "Sort" not in plan


def test_quantile_of_nothing_and_rank(spark):
    assert exact_quantile(spark.createDataFrame([], "v double"), "v", 0.9).first()[0] is None
    ranked = global_rank(spark.range(100).select((F.col("id") * 7 % 101).alias("k")), ["k"], "n")
    rows = sorted(ranked.collect())
    assert [r["n"] for r in rows] == list(range(1, 101))


def test_salted_lookup_matches_a_plain_join(spark):
    rows = spark.range(300).select("id", F.when(F.col("id") < 250, 1).otherwise(F.col("id") % 5).alias("k"))
    keys = spark.createDataFrame([(1, "a"), (3, "b"), (9, "c")], "k long, v string")
    rows = rows.withColumn("k", F.col("k").cast("long"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        got, want = salted_lookup(rows, keys, ["k"], how), rows.join(keys, "k", how)
        assert sorted(got.select(*want.columns).collect(), key=str) == sorted(want.collect(), key=str)


def test_a_table_that_is_sent_to_all_tasks_is_not_repeated(spark):
    rows, table = spark.range(50).selectExpr("id % 5 as k", "id"), spark.range(5).selectExpr("id as k", "id * 2 as v")

    def salted():
        plan = salted_lookup(rows, table, ["k"])._jdf.queryExecution().analyzed().toString()
        return "_salt" in plan

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    assert not salted()
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert salted()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_more_than_a_hundred_areas(spark):
    names = spark.range(1, 121).select("id", aoi.aoi_label(F.col("id")).alias("aoi_id")).orderBy("id")
    got = [r["aoi_id"] for r in names.collect()]
    assert got[0] == "AOI_01" and got[98:101] == ["AOI_99", "AOI_100", "AOI_101"]


@pytest.mark.parametrize("salts", [1, 7])
def test_thin_points_next_to_a_crowded_cell(spark, monkeypatch, salts):
    """However many parts a crowded cell is dealt into, its thin neighbours see all of it once."""
    gen = np.random.default_rng(3)
    crowd = gen.uniform(0, 60, (150, 2))
    lone = np.array([[130.0, 30.0], [30.0, -70.0], [250.0, 250.0], [160.0, 30.0]])
    pts = np.vstack([crowd, lone])
    monkeypatch.setattr(clustering, "measured_salts", lambda *_: salts)
    for eps, least in ((100.0, 5), (100.0, 200), (75.0, 3)):
        got = labels(clustering.dbscan(table(spark, pts), eps, least))
        assert [got[i] for i in range(len(pts))] == brute_dbscan(pts, eps, least).tolist()


def test_salts_follow_the_fullest_key(spark):
    rows = spark.range(100).selectExpr("id", "if(id < 70, 0L, id) as k")
    assert measured_salts(rows, ["k"], per_salt=20) == 4
    assert measured_salts(rows, ["k"]) == 1 and measured_salts(rows.limit(0), ["k"]) == 1
