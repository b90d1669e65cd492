"""Near-duplicate vectors by a pivot-permutation index.

A vector is described by its ``NEAREST`` reference points in the order of their similarity. Two vectors are candidates
when they share at least ``SHARED`` of them. The inverted lists are kept per set of ``SHARED`` pivots, so whoever meets
in a list shares that many; a pair is taken up in the first of the lists that both are in and its cosine is computed in
double precision. Rows of a list whose pivots put their pairs into an earlier list are skipped as a block.

Equal vectors are one class first. A large list is cut into blocks of ``BLOCK`` vectors and every pair of blocks is one
row that any task can take; from it come the number of links of each vector and as many links as connect what is linked.

The index is approximate in that a pair above the threshold may share fewer pivots: in 64 dimensions a pair at a cosine
of exactly 0.95 is found with a probability of about 0.99, at 0.97 above 0.998 (the tests measure it). Pivots are a
bounded sample of ``pivot_count`` vectors; every vector is indexed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdure.llm.vectors import choose_pivots, flat_lists, lists, padded, pivot_count, usable
from verdure.operators.components import connected_components
from verdure.session import materialize

COSINE = 0.95
NEAREST, SHARED = 8, 3
BLOCK = 128

_LISTS = pa.schema([("key", pa.int64()), ("cid", pa.int64()), ("earlier", pa.list_(pa.int32()))])
_FOUND = pa.schema([("cid", pa.int64()), ("links", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def permutations(vectors: np.ndarray, pivots: np.ndarray, nearest: int = NEAREST) -> np.ndarray:
    """The numbers of the nearest pivots (unit vectors) of each vector, the nearest first; ties go to the smaller number."""
    near = min(nearest, len(pivots))
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :near]


def _describe(pivots: np.ndarray, nearest: int, shared: int):
    """The entries of every vector in the lists of all ``shared``-subsets of its pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                vectors = padded(lists(part.column("embedding")), pivots.shape[1])
                near = np.sort(permutations(vectors, pivots, nearest), axis=1)
                cid = part.column("cid").to_numpy()
                for chosen in combinations(range(near.shape[1]), min(shared, near.shape[1])):
                    key = np.zeros(len(cid), np.int64)
                    for j in chosen:
                        key = key * 4096 + near[:, j]
                    # pivots of the vector that come before the list's last one and are not in its set
                    rest = [j for j in range(chosen[-1]) if j not in chosen]
                    offsets = np.arange(len(cid) + 1, dtype=np.int32) * len(rest)
                    earlier = pa.ListArray.from_arrays(offsets, pa.array(near[:, rest].astype(np.int32).ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(cid), earlier], schema=_LISTS)

    return run


def _spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Few links (row, column) that connect whatever the matrix of links connects."""
    rows, columns = linked.shape
    if int(linked.sum()) <= 4 * (rows + columns):
        return [(int(i), int(j)) for i, j in zip(*np.nonzero(linked), strict=True)]
    edges, seen_r, seen_c = [], np.zeros(rows, bool), np.zeros(columns, bool)
    for start in range(rows):
        if seen_r[start] or not linked[start].any():
            continue
        seen_r[start] = True
        front = [start]
        while front:
            nxt = []
            for i in front:
                fresh = np.flatnonzero(linked[i] & ~seen_c)
                seen_c[fresh] = True
                edges += [(i, int(j)) for j in fresh]
                reached = np.flatnonzero(linked[:, fresh].any(axis=1) & ~seen_r) if len(fresh) else fresh
                for r in reached:
                    edges.append((int(r), int(fresh[np.flatnonzero(linked[r, fresh])[0]])))
                seen_r[reached] = True
                nxt += reached.tolist()
            front = nxt
    return edges


def _verify(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("own").to_pylist()
            sides = [(lists(batch.column(f"cid{s}")), lists(batch.column(f"w{s}")), flat_lists(batch.column(f"x{s}"))) for s in ("", "2")]
            links: dict[int, int] = {}
            edges: set[tuple[int, int]] = set()
            for i, same in enumerate(own):
                (ca, wa, xa), (cb, wb, xb) = ((side[0][i], side[1][i], side[2][i].astype(np.float64)) for side in sides)
                cos = (xa @ xb.T) / np.outer(np.linalg.norm(xa, axis=1), np.linalg.norm(xb, axis=1))
                linked = cos >= cosine
                if same:
                    np.fill_diagonal(linked, False)
                if not linked.any():
                    continue
                for c, k in zip(ca.tolist(), (linked @ wb).tolist(), strict=True):
                    if k:
                        links[c] = links.get(c, 0) + int(k)
                if not same:
                    for c, k in zip(cb.tolist(), (wa @ linked).tolist(), strict=True):
                        if k:
                            links[c] = links.get(c, 0) + int(k)
                edges.update((int(min(ca[r], cb[c])), int(max(ca[r], cb[c]))) for r, c in _spanning(linked))
            if links:
                k, e = len(links), len(edges)
                a, b = zip(*edges, strict=True)
                none = pa.nulls(e, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(list(links)), pa.array(list(links.values())), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())], schema=_FOUND)
                yield pa.RecordBatch.from_arrays([none, none, pa.array(a), pa.array(b)], schema=_FOUND)

    return run


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, nearest: int = NEAREST, shared: int = SHARED, block: int = BLOCK
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding).

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and vectors of
    different lengths do not link. Repeated rows link with each other. ``component_id`` is the smallest vec_id
    reachable by links; rows without an id have the component of their links (null if alone) and are not kept. Other
    columns are not read; an empty table gives no rows.
    """
    # single precision is moved as such and widened before anything is computed
    element = vectors.schema["embedding"].dataType.elementType
    kind = "float" if isinstance(element, T.FloatType) else "double"
    rows = materialize(
        vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast(f"array<{kind}>")).select(
            "vec_id", F.when(usable() & F.exists("embedding", lambda x: x != 0), F.col("embedding")).alias("embedding")
        ),
        "vectors",
    )
    given = rows.where("embedding is not null")
    classes = given.groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("w"))
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    total = classes.count()
    outside = rows.where("embedding is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    if total:
        found = _linked(classes, total, cosine, nearest, shared, block)
        linked = found.where("cid is not null").groupBy("cid").agg(F.sum("links").alias("links"))
        label = connected_components(found.where("a is not null").select("a", "b").distinct())
        whole = label.join(classes.select(F.col("cid").alias("node"), "least"), "node").groupBy("component").agg(F.min("least").alias("whole"))
        reach = label.join(whole, "component").select(F.col("node").alias("cid"), "whole")
        told = classes.join(linked, "cid", "left").join(reach, "cid", "left").select(
            "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("w") - 1).cast("long").alias("n_links"),
            F.coalesce("whole", "least").alias("component_id"),
        )
        outside = outside.unionByName(given.join(told, "embedding").select("vec_id", "n_links", "component_id"))
    return outside.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _linked(classes: DataFrame, total: int, cosine: float, nearest: int, shared: int, block: int) -> DataFrame:
    pivots = choose_pivots(classes, pivot_count(total), unit=True)
    entries = classes.select("cid", "embedding").mapInArrow(
        _describe(pivots, nearest, shared), "key long, cid long, earlier array<int>"
    )
    entries = materialize(entries, "pivot-lists")
    several = entries.groupBy("key").agg(F.count("*").alias("k")).where("k > 1").select("key")
    entries = entries.join(several, "key", "left_semi")
    parts = entries.groupBy("key", "earlier").agg(F.ceil(F.count("*") / block).alias("parts"))
    dealt = entries.join(parts, ["key", "earlier"]).withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts")))
    held = dealt.join(classes.select("cid", "w", F.col("embedding").alias("x")), "cid")
    dims = held.withColumn("dim", F.size("x"))
    row = F.struct("cid", "w", "x")
    packed = dims.groupBy("key", "dim", "earlier", "part").agg(F.collect_list(row).alias("r"))
    blocks = materialize(
        packed.select("key", "dim", "earlier", "part", F.col("r.cid").alias("cid"), F.col("r.w").alias("w"), F.col("r.x").alias("x")),
        "pivot-blocks",
    )
    other = blocks.select("key", "dim", *[F.col(c).alias(f"{c}2") for c in ("earlier", "part", "cid", "w", "x")])
    order = F.struct("earlier", "part") <= F.struct(F.col("earlier2").alias("earlier"), F.col("part2").alias("part"))
    pairs = blocks.join(other, ["key", "dim"]).where(order & ~F.arrays_overlap("earlier", "earlier2"))
    same = (F.col("part") == F.col("part2")) & (F.col("earlier") == F.col("earlier2"))
    pairs = pairs.select("cid", "w", "x", "cid2", "w2", "x2", same.alias("own")).where(~F.col("own") | (F.size("cid") > 1))
    return materialize(pairs.mapInArrow(_verify(cosine), "cid long, links long, a long, b long"), "vector-links")
