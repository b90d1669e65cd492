"""Exact search for the largest inner products with a pivot-distance index.

Vectors are turned into integers, ``floor(256 * x)``. Each is keyed by its nearest pivot and its distance from it; the
vectors of a pivot are kept in rings (annuli) of about ``RING`` vectors. For a query ``q`` and a vector ``x`` of a ring
the triangle inequality gives ``|q - x| >= gap``, the distance from ``q``'s own distance to the ring's, and so
``q.x <= (|q|^2 + |x|^2 - gap^2) / 2``.

First each query looks only into the rings of its own pivot. The score of its last answer there is a floor for the
second pass, which takes all queries in blocks past all rings, the rings of a pivot in the order of their distance. A
query leaves out a ring whose bound is below its last answer so far. Scores are integers and the bounds leave room for
rounding, so the answers are exact, ties included.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdure.llm.vectors import choose_pivots, flat_lists, lists, padded, pivot_count, usable
from verdure.session import materialize

SCALE = 256
BEST = 5
#: Vectors per ring, queries per block and streams that share a block's rings.
RING = 512
QUERIES = 1024
STREAMS = 16

_KEYED = pa.schema([("uid", pa.int64()), ("pivot", pa.int64()), ("far", pa.float64())])
_ANSWERS = pa.schema([("query", pa.int64()), ("uid", pa.int64()), ("score", pa.int64())])
_ANSWERS_DDL = "query long, uid long, score long"
_LOWEST = np.iinfo(np.int64).min


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; doubles where all sums stay below 2**53."""
    reach = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if reach < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x**2).sum(axis=1)[:, None] - 2 * x @ pivots.T + (pivots**2).sum(axis=1)
    return np.sqrt(np.maximum(square, 0))


def _key(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4_000):
                part = batch.slice(at, 4_000)
                away = _distances(padded(lists(part.column("x")), pivots.shape[1]), pivots)
                near = away.argmin(axis=1)
                far = away[np.arange(len(near)), near]
                yield pa.RecordBatch.from_arrays([part.column("uid"), pa.array(near), pa.array(far)], schema=_KEYED)

    return run


class Block:
    """Queries that go past rings together; keeps the best answers of each so far."""

    def __init__(self, uid: np.ndarray, x: np.ndarray, rank: np.ndarray, floor: np.ndarray, pivots: np.ndarray, best: int):
        self.uid, self.x, self.rank, self.best = uid, x, rank, best
        wide = padded(list(x), pivots.shape[1])
        self.away, self.square = _distances(wide, pivots), (wide**2).sum(axis=1)
        self.scores = np.full((len(uid), best), _LOWEST)
        self.found = np.full((len(uid), best), -1, np.int64)
        self.order = np.full((len(uid), best), np.iinfo(np.int64).max)
        self.floor = floor

    def look(self, pivot: int, uid: np.ndarray, rank: np.ndarray, x: np.ndarray, far: np.ndarray) -> None:
        """``rank`` orders rows with equal scores; ``far`` is the distance from the ring's pivot."""
        gap = np.maximum(0, np.maximum(self.away[:, pivot] - far.max(), far.min() - self.away[:, pivot]))
        largest = float((x.astype(np.float64) ** 2).sum(axis=1).max())
        # room for the rounding of distances: squares are far larger than what they can be off
        room = 1e-6 * (self.square + largest) + 1
        bound = (self.square + largest - gap**2) / 2 + room
        asked = np.flatnonzero(bound >= np.maximum(self.scores[:, -1], self.floor))
        for at in range(0, len(asked), 256):
            self._merge(asked[at : at + 256], uid, rank, x)

    def _merge(self, asked: np.ndarray, uid: np.ndarray, rank: np.ndarray, x: np.ndarray) -> None:
        score = products(self.x[asked], x)
        score[self.uid[asked][:, None] == uid[None, :]] = _LOWEST
        k = min(self.best, score.shape[1])
        last = np.partition(score, score.shape[1] - k, axis=1)[:, -k] if score.shape[1] > k else np.full(len(asked), _LOWEST)
        # nothing below a query's last answer, or below the k-th score here, can be an answer
        least = np.maximum(np.maximum(last, self.scores[asked, -1]), self.floor[asked])
        row, column = np.nonzero((score >= least[:, None]) & (score > _LOWEST))
        if not len(row):
            return
        rows = np.concatenate([row, np.repeat(np.arange(len(asked)), self.best)])
        scores = np.concatenate([score[row, column], self.scores[asked].ravel()])
        ranks = np.concatenate([rank[column], self.order[asked].ravel()])
        uids = np.concatenate([uid[column], self.found[asked].ravel()])
        order = np.lexsort((ranks, -scores.astype(np.float64), rows)) if np.abs(scores[scores > _LOWEST]).max(initial=0) < 2**53 else np.lexsort((ranks, ~scores, rows))
        first = np.searchsorted(rows[order], np.arange(len(asked)))
        kept = order[first[:, None] + np.arange(self.best)]
        self.scores[asked], self.order[asked], self.found[asked] = scores[kept], ranks[kept], uids[kept]

    def answers(self) -> pa.RecordBatch:
        told = self.found >= 0
        query = np.repeat(self.uid, self.best).reshape(told.shape)[told]
        return pa.RecordBatch.from_arrays([pa.array(query), pa.array(self.found[told]), pa.array(self.scores[told])], schema=_ANSWERS)


def _pass(pivots: np.ndarray, best: int):
    """Streams of (block, stream), first the block's queries (ring -1), then rings in the order of pivot and distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = None, None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("block", "stream", "kind", "pivot")), strict=True))
            columns = [lists(batch.column(c)) for c in ("uid", "rank", "far", "floor")]
            xs = flat_lists(batch.column("x"))
            for i, (number, stream, kind, pivot) in enumerate(keys):
                uid, rank, far, floor = (c[i] for c in columns)
                if kind == 0:
                    if key == (number, stream):
                        raise ValueError("a block's queries come in one row")
                    if block is not None:
                        yield block.answers()
                    key, block = (number, stream), Block(uid, xs[i], rank, floor, pivots, best)
                elif block is not None and key == (number, stream):
                    block.look(pivot, uid, rank, xs[i], far)
        if block is not None:
            yield block.answers()

    return run


def _rows(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Vectors packed into one row per group."""
    row = F.struct("uid", "rank", "far", "floor", "x")
    packed = frame.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("r"))
    return packed.select(*keys, *[F.col(f"r.{c}").alias(c) for c in ("uid", "rank", "far", "floor", "x")])


def _search(queries: DataFrame, rings: DataFrame, pivots: np.ndarray, best: int) -> DataFrame:
    """The best answers of every (block, stream): both frames have block, stream, pivot, ring, kind and packed vectors."""
    both = queries.unionByName(rings)
    dealt = both.repartition(F.col("block"), F.col("stream")).sortWithinPartitions("block", "stream", "kind", "pivot", "ring")
    return dealt.mapInArrow(_pass(pivots, best), _ANSWERS_DDL)


def top_products(vectors: DataFrame, every: int = 50, best: int = BEST, ring: int = RING, block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``best`` largest inner products of each query with all other rows.

    Queries are the rows whose vec_id is divisible by ``every``. Ties go to the smaller vec_id, then to rows without
    one; a repeated row is another row and so an answer to its double. Vectors that are null, empty or hold null or
    non-finite components take no part; vectors are compared with those of their length. Scores have to fit 64 bits.
    Other columns are not read; an empty table gives no rows.
    """
    whole = F.transform("embedding", lambda v: F.floor(v.cast("double") * SCALE).cast("long"))
    given = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).where(usable())
    rows = materialize(given.select(F.monotonically_increasing_id().alias("uid"), "vec_id", whole.alias("x")), "search-vectors")
    total = rows.count()
    if not total:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score"))
    pivots = choose_pivots(rows, pivot_count(total), "x")
    keyed = rows.select("uid", "x").mapInArrow(_key(pivots), "uid long, pivot long, far double")
    rank = F.coalesce("vec_id", F.lit(2**63 - 1)).alias("rank")
    index = materialize(rows.join(keyed, "uid").select("uid", "vec_id", "x", "pivot", "far", rank, F.size("x").alias("dim")), "pivot-distances")

    # rings: a pivot's vectors cut by distance into strips of equal width, crowded strips dealt out by hash
    spread = index.groupBy("dim", "pivot").agg(F.min("far").alias("lo"), F.max("far").alias("hi"), F.ceil(F.count("*") / ring).alias("strips"))
    strips = index.join(spread, ["dim", "pivot"]).withColumn(
        "strip", F.least(F.col("strips") - 1, F.coalesce(F.floor(F.try_divide(F.col("far") - F.col("lo"), F.col("hi") - F.col("lo")) * F.col("strips")), F.lit(0)))
    )
    crowd = strips.groupBy("dim", "pivot", "strip").agg(F.ceil(F.count("*") / ring).alias("parts"))
    cut = strips.join(crowd, ["dim", "pivot", "strip"]).withColumn("part", F.pmod(F.xxhash64("uid"), F.col("parts")))
    ringed = cut.withColumn("ring", F.struct("strip", "part")).withColumn("floor", F.lit(_LOWEST))
    rings = materialize(_rows(ringed, ["dim", "pivot", "ring"]).withColumn("kind", F.lit(1)), "rings")

    asked = index.where(F.col("vec_id") % every == 0)
    first = F.struct(F.lit(-1).cast("long").alias("strip"), F.lit(-1).cast("long").alias("part"))
    # first pass: blocks of queries of one pivot, and that pivot's rings
    counts = asked.groupBy("dim", "pivot").agg(F.ceil(F.count("*") / block).alias("blocks"))
    part = F.pmod(F.xxhash64("uid"), F.col("blocks"))
    name = F.struct("dim", "pivot", "part").alias("block")
    own = asked.join(counts, ["dim", "pivot"]).withColumn("part", part).withColumn("floor", F.lit(_LOWEST))
    seeds = _rows(own, ["dim", "pivot", "part"]).select(name, F.lit(0).cast("long").alias("stream"), F.lit(0).alias("kind"), "pivot", first.alias("ring"), "uid", "rank", "far", "floor", "x")
    near = rings.join(counts, ["dim", "pivot"]).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    near = near.select(name, F.lit(0).cast("long").alias("stream"), "kind", "pivot", "ring", "uid", "rank", "far", "floor", "x")
    seeded = _search(seeds, near, pivots, best).groupBy("query").agg(F.count("*").alias("k"), F.min("score").alias("floor"))
    floors = materialize(seeded.where(F.col("k") == best).select(F.col("query").alias("uid"), "floor"), "search-floors")

    # second pass: all queries of a length in blocks, all rings of that length
    blocks = asked.groupBy("dim").agg(F.ceil(F.count("*") / block).alias("blocks"))
    all_asked = asked.join(floors, "uid", "left").withColumn("floor", F.coalesce("floor", F.lit(_LOWEST)))
    all_asked = all_asked.join(blocks, "dim").withColumn("part", part)
    name = F.struct("dim", F.lit(-1).cast("long").alias("pivot"), "part").alias("block")
    packed = _rows(all_asked, ["dim", "part"]).withColumn("stream", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(STREAMS - 1).cast("long"))))
    packed = packed.select(name, "stream", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("pivot"), first.alias("ring"), "uid", "rank", "far", "floor", "x")
    wide = rings.join(blocks, "dim").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    wide = wide.select(name, F.pmod(F.xxhash64("pivot", "ring"), F.lit(STREAMS)).alias("stream"), "kind", "pivot", "ring", "uid", "rank", "far", "floor", "x")
    answers = materialize(_search(packed, wide, pivots, best), "search-answers")

    ids = rows.select("uid", "vec_id")
    told = answers.join(ids, "uid").join(ids.select(F.col("uid").alias("query"), F.col("vec_id").alias("query_id")), "query")
    order = F.struct((-F.col("score")).alias("s"), F.col("vec_id").isNull().alias("n"), "vec_id", "uid")
    ranked = told.groupBy("query", "query_id").agg(F.slice(F.array_sort(F.collect_list(order)), 1, best).alias("a"))
    out = ranked.select("query_id", F.posexplode("a").alias("p", "x"))
    return out.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.s")).alias("score"))
