"""Exact nearest-neighbour distance and radius pairs on planar points.

Points carry ``ord`` (unique long) and metre coordinates ``x``, ``y``.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdure.operators.skew import salted_lookup
from verdure.session import materialize

LEAF_SITES = 32  # a start cell holding more distinct positions than this is split
FINEST_LEVEL = -10  # cell side 2**-10 m, below the millimetre grid of the inputs
SMALL_RUNGS = 2  # rungs below the root with at most 4 * 64**(SMALL_RUNGS - 1) = 256 cells in all, which fit any task
STEP = 3  # levels between a cell and the next finer one that is tried


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by))


def neighbour_offsets(reach: int, forward_only: bool = False) -> Column:
    """Literal array of struct(dx, dy) over the square of cells within ``reach``.

    ``forward_only`` keeps one of each opposite pair and leaves out (0, 0).
    """
    span = range(-reach, reach + 1)
    pairs = [(dx, dy) for dx in span for dy in span if not forward_only or (dx, dy) > (0, 0)]
    return F.expr("array(%s)" % ", ".join(f"struct({dx} as dx, {dy} as dy)" for dx, dy in pairs))


def _cell(coordinate: Column, level: Column) -> Column:
    # sides are powers of two, so cell borders are exact doubles
    return F.floor(coordinate / F.pow(F.lit(2.0), level))


def _start_levels(
    sites: DataFrame, n: int, width: float, height: float
) -> tuple[DataFrame, DataFrame | None, list[int]]:
    """Give each position the level of a grid cell with few positions in it.

    The first level suits evenly spread points; only cells that are too full are
    tried again on a finer grid, so a dense spot is never searched cell against cell.
    Also returns the cells that were too full, with the box of their positions, and the levels tried.
    """
    area = max(width, 1e-3) * max(height, 1e-3)
    level = max(FINEST_LEVEL, math.ceil(math.log2(math.sqrt(area / n))))
    active, settled, crowded, levels = sites.withColumn("level", F.lit(level)), [], [], [level]
    while True:
        active = active.withColumn("cx", _cell(F.col("x"), F.col("level"))).withColumn(
            "cy", _cell(F.col("y"), F.col("level"))
        )
        full = active.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n"), *_box("x", "y")).where(
            F.col("n") > LEAF_SITES
        )
        if level <= FINEST_LEVEL or full.isEmpty():
            settled.append(active)
            return reduce(DataFrame.unionByName, settled), reduce(DataFrame.unionByName, crowded) if crowded else None, levels
        full = materialize(full, "full-cells")
        crowded.append(full.withColumn("level", F.lit(level)))
        settled.append(salted_lookup(active, full.select("cx", "cy"), ["cx", "cy"], "left_anti"))
        level = max(FINEST_LEVEL, level - STEP)
        levels.append(level)
        active = materialize(
            salted_lookup(active, full.select("cx", "cy"), ["cx", "cy"], "left_semi")
            .drop("cx", "cy")
            .withColumn("level", F.lit(level)),
            "dense-sites",
        )


def nearest_distance(points: DataFrame) -> DataFrame:
    """(ord, nn_dist): distance to the nearest other point; null for a lone point.

    Copies of one position are folded first and get distance 0. Each position then
    looks at the 3x3 cells around it, of crowded ones only at the box of their positions; its minimum is final
    when neither a point outside the block nor one in such a box can be nearer. The rest go down a
    tree of cells (``nearest_in_tree``), so no position ever meets all positions of a crowded cell.
    """
    sites = materialize(
        points.groupBy("x", "y").agg(F.count(F.lit(1)).alias("copies")), "sites"
    )
    n, x0, x1, y0, y1 = sites.agg(
        F.count(F.lit(1)), F.min("x"), F.max("x"), F.min("y"), F.max("y")
    ).first()
    if n < 2:
        alone = F.when(F.col("copies") > 1, F.lit(0.0))
        nearest = sites.select("x", "y", alone.alias("nn_dist"))
    else:
        settled, crowded, levels = _start_levels(sites, n, x1 - x0, y1 - y0)
        settled = materialize(settled, "settled")
        searched = materialize(_search_block(settled.where("copies = 1"), settled, crowded, levels), "searched")
        blocked = F.coalesce(F.col("box_dist") < F.col("nn_dist"), F.lit(False))
        final = F.coalesce(F.col("nn_dist") <= F.col("reach"), F.lit(False)) & ~blocked
        rest = searched.where(~final).select("x", "y", "nn_dist")
        done = [
            sites.where("copies > 1").select("x", "y", F.lit(0.0).alias("nn_dist")),
            searched.where(final).select("x", "y", "nn_dist"),
        ]
        if not rest.isEmpty():
            rungs = _rungs(levels, max(x1 - x0, y1 - y0))
            done.append(nearest_in_tree(rest, settled, cell_tree(settled, rungs), rungs).drop("read"))
        nearest = reduce(DataFrame.unionByName, done)
    return salted_lookup(points.select("ord", "x", "y"), nearest, ["x", "y"]).select(
        "ord", "nn_dist"
    )


def _search_block(probes: DataFrame, settled: DataFrame, crowded: DataFrame | None, levels: list[int]) -> DataFrame:
    """(x, y, nn_dist, box_dist, reach): what each probe sees in its 3x3 block of cells.

    ``nn_dist`` is the least distance to another site of the cells that are not crowded, ``box_dist`` that to the box
    of a crowded one, ``reach`` that to the end of the block. A site is in uncrowded cells at its own level and below.
    """
    side = F.pow(F.lit(2.0), F.col("level"))
    below = F.filter(F.array(*map(F.lit, levels)), lambda l: l <= F.col("level"))
    targets = (
        settled.select("x", "y", F.explode(below).alias("level"))
        .withColumn("cx", _cell(F.col("x"), F.col("level")))
        .withColumn("cy", _cell(F.col("y"), F.col("level")))
    )
    if crowded is not None:
        targets = targets.unionByName(crowded.drop("n"), allowMissingColumns=True)
    fx, fy = F.col("x") - F.col("cx") * side, F.col("y") - F.col("cy") * side
    looks = (
        probes.withColumn("reach", side + F.least(fx, fy, side - fx, side - fy))
        .withColumn("o", F.explode(neighbour_offsets(1)))
        .select(
            F.col("x").alias("px"),
            F.col("y").alias("py"),
            "reach",
            "level",
            (F.col("cx") + F.col("o.dx")).alias("cx"),
            (F.col("cy") + F.col("o.dy")).alias("cy"),
        )
    )
    px, py = F.col("px"), F.col("py")
    other = (F.col("x") != px) | (F.col("y") != py)
    apart = distance(F.col("x"), F.col("y"), px, py)
    boxed = F.lit(None).cast("double")
    if crowded is not None:
        boxed = F.min(F.when(F.col("xmin").isNotNull(), _to_box(px, py, F.col)))
    return (
        looks.join(targets, ["level", "cx", "cy"])
        .groupBy("px", "py")
        .agg(F.min(F.when(other, apart)).alias("nn_dist"), boxed.alias("box_dist"), F.first("reach").alias("reach"))
        .withColumnsRenamed({"px": "x", "py": "y"})
    )


def _box(x: str, y: str) -> list[Column]:
    """Aggregates (xmin, ymin, xmax, ymax) of a group of positions."""
    return [F.min(x).alias("xmin"), F.min(y).alias("ymin"), F.max(x).alias("xmax"), F.max(y).alias("ymax")]


def _to_box(px: Column, py: Column, of) -> Column:
    """Distance to the box whose sides ``of`` gives by name; 0 inside. Never above that to a site in it, digit by digit."""
    zero = F.lit(0.0)
    dx = F.greatest(of("xmin") - px, px - of("xmax"), zero)
    dy = F.greatest(of("ymin") - py, py - of("ymax"), zero)
    return F.sqrt(dx * dx + dy * dy)


def _surely_within(px: Column, py: Column, of) -> Column:
    """A distance within which the box has a site, as each of its sides touches one."""
    x1, x2 = F.abs(of("xmin") - px), F.abs(of("xmax") - px)
    y1, y2 = F.abs(of("ymin") - py), F.abs(of("ymax") - py)
    nx, fx, ny, fy = F.least(x1, x2), F.greatest(x1, x2), F.least(y1, y2), F.greatest(y1, y2)
    return F.sqrt(F.least(nx * nx + fy * fy, fx * fx + ny * ny))


def _rungs(levels: list[int], extent: float) -> list[int]:
    """Levels of the cell tree from the top: ``levels`` and, above them, as many as the extent needs.

    At the topmost one all sites lie in at most four cells.
    """
    rungs = list(levels)
    while 2.0 ** rungs[0] < extent:
        rungs.insert(0, rungs[0] + STEP)
    return rungs


NODE = ["level", "cx", "cy"]
SIDES = ["xmin", "ymin", "xmax", "ymax"]


def cell_tree(settled: DataFrame, rungs: list[int]) -> DataFrame:
    """(level, cx, cy, kids): every inner cell with summaries of the cells one rung below it.

    ``settled`` holds sites with the cell that they settled in, the leaves. A summary is (level, cx, cy, n, leaf) and the
    box of its sites; a cell has at most 4**STEP. The row of level ``rungs[0] + 1`` is the root.
    """
    leaves = settled.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n"), *_box("x", "y"))
    above = F.filter(F.array(*map(F.lit, rungs)), lambda l: l > F.col("level"))
    inner = (
        leaves.withColumn("level", F.explode(above))
        .withColumn("cx", _cell(F.col("xmin"), F.col("level")))
        .withColumn("cy", _cell(F.col("ymin"), F.col("level")))
        .groupBy(*NODE)
        .agg(F.sum("n").alias("n"), *[(F.min if s.endswith("min") else F.max)(s).alias(s) for s in SIDES])
    )
    nodes = leaves.withColumn("leaf", F.lit(True)).unionByName(inner.withColumn("leaf", F.lit(False)))
    steps = [F.lit(i) for pair in zip(rungs[1:], rungs) for i in pair]
    parent = F.element_at(F.create_map(*steps), F.col("level")) if steps else F.lit(None).cast("int")
    root = F.col("level") == rungs[0]

    def up(side: str) -> Column:
        return F.when(root, F.lit(0).cast("long")).otherwise(_cell(F.col(side), F.col("parent")))

    return materialize(
        nodes.withColumn("parent", F.when(root, F.lit(rungs[0] + 1)).otherwise(parent))
        .select("parent", up("xmin").alias("ux"), up("ymin").alias("uy"), F.struct(*NODE, "n", "leaf", *SIDES).alias("kid"))
        .groupBy("parent", "ux", "uy")
        .agg(F.collect_list("kid").alias("kids"))
        .withColumnsRenamed({"parent": "level", "ux": "cx", "uy": "cy"}),
        "cell-tree",
    )


def nearest_in_tree(probes: DataFrame, settled: DataFrame, tree: DataFrame, rungs: list[int]) -> DataFrame:
    """(x, y, nn_dist, read): least distance to another site and the number of sites it was found among.

    ``probes`` are sites (x, y) with a distance that another one is known to have, or null. A first way down takes the
    nearest box at every rung and gives a close bound; the second one keeps all cells whose box is within it. Both are
    chains of joins with the rows of one rung, and a bound gets tighter on the way without meeting other rows.
    """
    px, py = F.col("px"), F.col("py")
    root = [F.lit(rungs[0] + 1).alias("level"), *[F.lit(0).cast("long").alias(c) for c in ("cx", "cy")]]
    at_root = probes.select(
        F.col("x").alias("px"),
        F.col("y").alias("py"),
        F.col("nn_dist").alias("bound"),
        F.lit(0).cast("long").alias("read"),
        *root,
    )

    def down(rows: DataFrame, chosen) -> DataFrame:
        for depth, level in enumerate([rungs[0] + 1, *rungs[:-1]]):
            rung = tree.where(F.col("level") == level)
            if depth == 0:
                met = rows.withColumn("kids", rung.select("kids").scalar())
            elif depth <= SMALL_RUNGS:
                met = rows.join(F.broadcast(rung), NODE, "left")
            else:
                met = salted_lookup(rows, rung, NODE, "left", by=["px", "py"])
            seen = F.transform(
                "kids",
                lambda k: F.struct(
                    _to_box(px, py, k.getField).alias("near"),
                    _surely_within(px, py, k.getField).alias("sure"),
                    k["n"].alias("n"),
                    *[k[c].alias(c) for c in NODE],
                ),
            )
            # a single site at no distance is the probe itself
            met = met.withColumn("seen", F.filter(seen, lambda k: (k["n"] > 1) | (k["near"] > 0)))
            rows = chosen(met)
        return rows

    def nearest_box(met: DataFrame) -> DataFrame:
        best = F.array_min("seen")
        return met.select("px", "py", "bound", "read", *[F.coalesce(best[c], F.col(c)).alias(c) for c in NODE])

    def within_bound(met: DataFrame) -> DataFrame:
        sure = F.array_min(F.transform("seen", lambda k: F.when(k["near"] > 0, k["sure"])))
        met = met.withColumn("bound", F.least("bound", sure))
        kept = F.transform(
            F.filter("seen", lambda k: k["near"] <= F.col("bound")), lambda k: F.struct(*[k[c].alias(c) for c in NODE])
        )
        stays = F.array(F.struct(*NODE))
        return met.withColumn("to", F.explode(F.coalesce(kept, stays))).select(
            "px", "py", "bound", "read", *[F.col("to")[c].alias(c) for c in NODE]
        )

    other = (F.col("x") != px) | (F.col("y") != py)
    apart = F.min(F.when(other, distance(F.col("x"), F.col("y"), px, py)))

    def among_sites(rows: DataFrame) -> DataFrame:
        met = salted_lookup(rows, settled.select("x", "y", *NODE), NODE, by=["px", "py"])
        return met.groupBy("px", "py").agg(
            apart.alias("found"), F.min("bound").alias("bound"), (F.first("read") + F.count(F.lit(1))).alias("read")
        )

    first = among_sites(down(at_root, nearest_box))
    bounded = first.select("px", "py", F.least("found", "bound").alias("bound"), "read", *root)
    return among_sites(down(bounded, within_bound)).select(
        F.col("px").alias("x"), F.col("py").alias("y"), F.col("found").alias("nn_dist"), "read"
    )


def radius_pairs(points: DataFrame, eps: float) -> DataFrame:
    """(a, b, dist) for every two points with ``dist <= eps``, each pair once (a < b).

    The result itself can be quadratic where points pile up; clustering therefore
    works on cells (``clustering.dbscan``) and never forms this table.
    """
    keyed = points.select("ord", "x", "y").withColumns(
        {"cx": F.floor(F.col("x") / eps), "cy": F.floor(F.col("y") / eps)}
    )
    probes = (
        keyed.withColumn("o", F.explode(neighbour_offsets(1)))
        .select(
            F.col("ord").alias("a"),
            F.col("x").alias("ax"),
            F.col("y").alias("ay"),
            (F.col("cx") + F.col("o.dx")).alias("cx"),
            (F.col("cy") + F.col("o.dy")).alias("cy"),
        )
    )
    dist = distance(F.col("ax"), F.col("ay"), F.col("x"), F.col("y"))
    return (
        probes.join(keyed.withColumnRenamed("ord", "b"), ["cx", "cy"])
        .where(F.col("a") < F.col("b"))
        .select("a", "b", dist.alias("dist"))
        .where(F.col("dist") <= eps)
    )
