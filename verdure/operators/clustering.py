"""Exact density clustering (DBSCAN) on planar points as grid-cell joins."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdure.operators.components import connected_components
from verdure.operators.neighbors import distance, neighbour_offsets
from verdure.operators.ranking import global_rank
from verdure.operators.skew import measured_salts, salted_lookup
from verdure.session import materialize

REACH = 2  # cells of side eps/sqrt(2): anything within eps lies at most two cells away
DIRECT_PAIRS = 4096  # two cells with at most this many point pairs are compared outright
SPLIT = 4  # fuller cell pairs are narrowed down on cells this many times finer


def core_cell_side(eps: float) -> float:
    """Cell side that keeps any two points of one cell within ``eps``.

    The small shrink absorbs the rounding of the division by the side.
    """
    return eps / math.sqrt(2.0) * (1 - 1e-6)


def dbscan(points: DataFrame, eps: float, min_samples: int) -> DataFrame:
    """(ord, label, cluster) of every point.

    ``label`` is the cluster number, -1 for noise. A point counts towards its own
    ``min_samples``; ``dist <= eps`` are neighbours. Clusters are numbered by their first
    core point in ``ord`` order and a border point goes to the lowest-numbered cluster
    that reaches it. ``cluster`` turns noise points into clusters of their own, numbered
    after the last one in ``ord`` order; without any cluster everything is cluster 0.

    Copies of a position are folded into one weighted site. All points of a cell of
    side eps/sqrt(2) are neighbours, so a cell with ``min_samples`` points is core as
    a whole without looking at pairs; only points of thinner cells count their
    neighbours. Clusters are the components of the graph of core cells.
    """
    side = core_cell_side(eps)
    sites = materialize(
        points.groupBy("x", "y")
        .agg(F.count(F.lit(1)).alias("weight"), F.min("ord").alias("first_ord"))
        .withColumn("cx", F.floor(F.col("x") / side))
        .withColumn("cy", F.floor(F.col("y") / side)),
        "sites",
    )
    flagged = materialize(_flag_core(sites, eps, min_samples), "core-flags")
    core = flagged.where("core")
    cells = materialize(
        core.groupBy("cx", "cy").agg(
            F.count(F.lit(1)).alias("n"),
            F.min("first_ord").alias("id"),
            *_box_aggregates(),
        ),
        "core-cells",
    )
    linked = connected_components(_core_links(core, cells, eps))
    grouped = cells.select("cx", "cy", "id").join(
        linked.withColumnRenamed("node", "id"), "id", "left"
    ).withColumn("component", F.coalesce("component", "id"))
    # the least core ord of a component is its root and gives its cluster's place
    roots = grouped.groupBy("component").agg(F.min("id").alias("root"))
    cell_roots = materialize(
        salted_lookup(grouped, roots, ["component"]).select("cx", "cy", "root"), "cell-roots"
    )
    core_sites = salted_lookup(core, cell_roots, ["cx", "cy"])
    border = _border_roots(flagged.where("not core"), core_sites, eps)
    site_roots = core_sites.select("x", "y", "root").unionByName(border)
    rooted = salted_lookup(points.select("ord", "x", "y"), site_roots, ["x", "y"], "left")
    return number_clusters(rooted.select("ord", "root"))


def number_clusters(rooted: DataFrame) -> DataFrame:
    """(ord, label, cluster) from each point's ``root``, which is null for noise.

    One global numbering covers both: clusters in root order, then noise in ord order.
    The cluster numbers have no gaps.
    """
    keyed = materialize(
        rooted.select(
            "ord",
            F.when(F.col("root").isNull(), 1).otherwise(0).alias("noise"),
            F.coalesce("root", "ord").alias("id"),
        ),
        "rooted",
    )
    ranked = global_rank(keyed.select("noise", "id").distinct(), ["noise", "id"], "n")
    if keyed.where("noise = 0").isEmpty():
        cluster = F.lit(0).cast("long")
    else:
        cluster = F.col("n") - 1
    return salted_lookup(keyed, ranked, ["noise", "id"]).select(
        "ord",
        F.when(F.col("noise") == 1, F.lit(-1)).otherwise(F.col("n") - 1).alias("label"),
        cluster.alias("cluster"),
    )


def _box_aggregates() -> list[Column]:
    return [
        F.min("x").alias("xmin"),
        F.min("y").alias("ymin"),
        F.max("x").alias("xmax"),
        F.max("y").alias("ymax"),
    ]


def _around(df: DataFrame, keep: dict[str, str]) -> DataFrame:
    """Repeat each row for the cells within reach, other than its own cell."""
    return (
        df.withColumn("o", F.explode(neighbour_offsets(REACH)))
        .where("o.dx <> 0 or o.dy <> 0")
        .select(
            *(F.col(src).alias(dst) for src, dst in keep.items()),
            (F.col("cx") + F.col("o.dx")).alias("cx"),
            (F.col("cy") + F.col("o.dy")).alias("cy"),
        )
    )


def _flag_core(sites: DataFrame, eps: float, min_samples: int) -> DataFrame:
    weights = sites.groupBy("cx", "cy").agg(F.sum("weight").alias("cell_weight"))
    weighed = salted_lookup(sites, weights, ["cx", "cy"])
    # fewer than min_samples points per cell are left to look around
    thin = weighed.where(F.col("cell_weight") < min_samples)
    probes = _around(thin, {"x": "px", "y": "py"})
    near = distance(F.col("px"), F.col("py"), F.col("x"), F.col("y")) <= eps
    # a cell is looked at by few thin points, but may hold very many sites: those are spread
    salts = measured_salts(sites, ["cx", "cy"])
    found = (
        salted_lookup(sites.select("cx", "cy", "x", "y", "weight"), probes, ["cx", "cy"], by=["x", "y"], salts=salts)
        .where(near)
        .groupBy(F.col("px").alias("x"), F.col("py").alias("y"))
        .agg(F.sum("weight").alias("outside"))
    )
    counted = weighed.join(found, ["x", "y"], "left")
    enough = F.col("cell_weight") + F.coalesce("outside", F.lit(0)) >= min_samples
    return counted.select("x", "y", "weight", "first_ord", "cx", "cy", enough.alias("core"))


def _border_roots(rest: DataFrame, core_sites: DataFrame, eps: float) -> DataFrame:
    """(x, y, root) of non-core sites in reach of a core site."""
    own = rest.select(F.col("x").alias("px"), F.col("y").alias("py"), "cx", "cy")
    probes = own.unionByName(_around(rest, {"x": "px", "y": "py"}))
    near = distance(F.col("px"), F.col("py"), F.col("x"), F.col("y")) <= eps
    salts = measured_salts(core_sites, ["cx", "cy"])
    return (
        salted_lookup(core_sites.select("cx", "cy", "x", "y", "root"), probes, ["cx", "cy"], by=["x", "y"], salts=salts)
        .where(near)
        .groupBy(F.col("px").alias("x"), F.col("py").alias("y"))
        .agg(F.min("root").alias("root"))
    )


def _box_gap(lo_a: str, hi_a: str, lo_b: str, hi_b: str) -> Column:
    return F.greatest(F.col(lo_b) - F.col(hi_a), F.col(lo_a) - F.col(hi_b), F.lit(0.0))


def _box_span(lo_a: str, hi_a: str, lo_b: str, hi_b: str) -> Column:
    return F.greatest(F.col(hi_b) - F.col(lo_a), F.col(hi_a) - F.col(lo_b))


def _norm(dx: Column, dy: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy)


def _core_links(core: DataFrame, cells: DataFrame, eps: float) -> DataFrame:
    """(a, b) ids of neighbouring core cells holding two core points within ``eps``.

    Cell pairs are settled by the boxes of their points where these are surely near
    or surely apart. Undecided pairs of thin cells compare their points; undecided
    pairs of full cells are narrowed down on ever finer cells, so two crowded cells
    are never multiplied out.
    """
    side = core_cell_side(eps)
    ends = ["n", "xmin", "ymin", "xmax", "ymax"]

    def tagged(df: DataFrame, end: str, keys: list[str]) -> DataFrame:
        return df.select(
            *(F.col(k).alias(f"{end}_{k}") for k in keys), *(F.col(c).alias(f"{end}_{c}") for c in ends)
        )

    left = cells.withColumn("o", F.explode(neighbour_offsets(REACH, forward_only=True)))
    a = left.select(
        F.col("id").alias("a"),
        F.col("cx").alias("a_kx"),
        F.col("cy").alias("a_ky"),
        *(F.col(c).alias(f"a_{c}") for c in ends),
        (F.col("cx") + F.col("o.dx")).alias("b_kx"),
        (F.col("cy") + F.col("o.dy")).alias("b_ky"),
    )
    b = tagged(cells.withColumnsRenamed({"cx": "kx", "cy": "ky"}), "b", ["kx", "ky"]).join(
        cells.select(F.col("cx").alias("b_kx"), F.col("cy").alias("b_ky"), F.col("id").alias("b")),
        ["b_kx", "b_ky"],
    )
    frontier = a.join(b, ["b_kx", "b_ky"])
    links: list[DataFrame] = []
    while True:
        gap = _norm(
            _box_gap("a_xmin", "a_xmax", "b_xmin", "b_xmax"),
            _box_gap("a_ymin", "a_ymax", "b_ymin", "b_ymax"),
        )
        span = _norm(
            _box_span("a_xmin", "a_xmax", "b_xmin", "b_xmax"),
            _box_span("a_ymin", "a_ymax", "b_ymin", "b_ymax"),
        )
        scored = materialize(
            frontier.withColumn("sure", span <= eps).where(gap <= eps), "cell-pairs"
        )
        sure = scored.where("sure").select("a", "b").distinct()
        links.append(sure)
        unsure = scored.join(sure, ["a", "b"], "left_anti")
        pairs = F.col("a_n") * F.col("b_n")
        links.append(_compare_points(unsure.where(pairs <= DIRECT_PAIRS), core, side, eps))
        crowded = scored.where(pairs > DIRECT_PAIRS)
        if crowded.isEmpty():
            return reduce(DataFrame.unionByName, links).distinct()
        crowded = unsure.where(pairs > DIRECT_PAIRS)
        finer = side / SPLIT
        nodes = materialize(
            _keyed(core, finer).groupBy("kx", "ky").agg(
                F.count(F.lit(1)).alias("n"), *_box_aggregates()
            ),
            "fine-cells",
        )
        parents = {
            "pkx": F.floor(F.col("kx") / F.lit(SPLIT)),
            "pky": F.floor(F.col("ky") / F.lit(SPLIT)),
        }
        children = nodes.withColumns(parents)
        open_pairs = crowded.select("a", "b", "a_kx", "a_ky", "b_kx", "b_ky")
        for end in ("a", "b"):
            child = tagged(children, end, ["kx", "ky"]).join(
                children.select(
                    F.col("kx").alias(f"{end}_kx"),
                    F.col("ky").alias(f"{end}_ky"),
                    F.col("pkx").alias(f"{end}_pkx"),
                    F.col("pky").alias(f"{end}_pky"),
                ),
                [f"{end}_kx", f"{end}_ky"],
            )
            open_pairs = open_pairs.withColumnsRenamed(
                {f"{end}_kx": f"{end}_pkx", f"{end}_ky": f"{end}_pky"}
            ).join(child, [f"{end}_pkx", f"{end}_pky"]).drop(f"{end}_pkx", f"{end}_pky")
        frontier, side = open_pairs, finer


def _keyed(core: DataFrame, side: float) -> DataFrame:
    return core.select(
        "x", "y", F.floor(F.col("x") / side).alias("kx"), F.floor(F.col("y") / side).alias("ky")
    )


def _compare_points(pairs: DataFrame, core: DataFrame, side: float, eps: float) -> DataFrame:
    keyed = _keyed(core, side)
    cells = ["a_kx", "a_ky", "b_kx", "b_ky"]

    def sites_of(end: str) -> DataFrame:
        sites = keyed.select(*(F.col(c).alias(f"{end}_{c}") for c in ("kx", "ky", "x", "y")))
        table = pairs.select("a", "b", *cells)
        return salted_lookup(sites, table, [f"{end}_kx", f"{end}_ky"])

    near = distance(F.col("a_x"), F.col("a_y"), F.col("b_x"), F.col("b_y")) <= eps
    both = sites_of("a").join(sites_of("b"), ["a", "b", *cells])
    return both.where(near).select("a", "b").distinct()
