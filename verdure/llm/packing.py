"""Packing of documents into token sequences by deficit round-robin over source queues.

Every source is a queue of its documents' tokens. A window of ``WINDOW`` sequences gives each source a quantum of
tokens in proportion to its target; what rounding denies a source stays on its account and is paid in a later
window. Runs of the sources follow each other in a window, starting with another source each time, and the window is
cut into sequences, so documents are cut only at the ends of runs and of sequences and a full sequence has no padding.

To work in parallel the schedule is cut into segments of about ``SEGMENT_TOKENS``. At a given virtual time ``v`` the
fluid schedule has served ``min(total, weight * v)`` tokens of a source; whole tokens below that belong to earlier
segments and the fraction is the account that the source brings along, so deficits carry on across tasks. The sources'
totals and weights are all that every task needs: one row per mixture component.

Targets default to the sources' shares of all tokens, which keeps the mixture the same to the end. With other
weights a source that runs dry leaves its share to the rest. What remains at the end of a segment after the last full
sequence goes into sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdure.llm.chunks import coder, groups, little_endian
from verdure.llm.common import batch_of, rows_of
from verdure.llm.memory import tidy
from verdure.session import materialize

LENGTH = 2048
#: Sequences per window, windows per segment.
WINDOW = 64
SEGMENT_WINDOWS = 24
#: Segments are dealt to at most so many tasks at once; a task works on them one after the other.
MOST_TASKS = 20_000

_TOKENS = pa.schema(
    [("doc_id", pa.int64()), ("queue", pa.string()), ("part", pa.int64()), ("within", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())]
)
_DEALT = pa.schema(
    [("segment", pa.int64()), ("queue_no", pa.int64()), ("at", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64())]
    + [("n", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())]
)
_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    + [("sequence_id", pa.int64()), ("offset", pa.int64()), ("queue", pa.string()), ("window", pa.int64()), ("ids", pa.binary())]
)


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    return ", ".join(f"`{f.name}` {kinds[f.type]}" for f in schema)


def _stored(ids: bytes, pack: zstandard.ZstdCompressor) -> bytes:
    return pack.compress(ids)


def _plain(stored: bytes, unpack: zstandard.ZstdDecompressor) -> bytes:
    return unpack.decompress(stored)


def queue_name(source: str = "source"):
    """The queue of a row; rows without a source have one of their own."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("none"))


def tokenize(docs: DataFrame, kind: str, tokenizer: str, end_id: int) -> DataFrame:
    """Tokens of every document with its place among its source's tokens in the same task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, tail = coder(kind, tokenizer), little_endian([end_id])
        pack = zstandard.ZstdCompressor(level=1)
        part = TaskContext.get().partitionId()
        served: dict[str, int] = {}
        for rows, texts in groups(batches):
            queues, within, counts, stored = rows.column("queue").to_pylist(), [], [], []
            for queue, ids in zip(queues, encode(texts), strict=True):
                ids += tail
                n = len(ids) // 4
                within.append(served.get(queue, 0))
                served[queue] = within[-1] + n
                counts.append(n)
                stored.append(_stored(_narrow(ids), pack))
            yield batch_of(_TOKENS, rows.column("doc_id"), queues, [part] * len(queues), within, counts, stored)

    rows = docs.select(F.col("doc_id").cast("long"), queue_name().alias("queue"), F.col("text").cast("string"))
    return rows.mapInArrow(tidy(run), _ddl(_TOKENS))


def _narrow(ids: bytes) -> bytes:
    """A width byte and the ids in two bytes each where they fit."""
    x = np.frombuffer(ids, "<u4")
    return b"\2" + x.astype("<u2").tobytes() if x.max(initial=0) < 2**16 else b"\4" + ids


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype("<u4")


@dataclass
class Schedule:
    """The fluid schedule of all queues and its cuts into segments."""

    queues: list[str]
    totals: np.ndarray
    weights: np.ndarray
    segments: int

    @classmethod
    def of(cls, totals: dict[str, int], weights: dict[str, float] | None, segment_tokens: int) -> Schedule:
        queues = sorted(totals)
        total = np.asarray([totals[q] for q in queues], dtype=np.int64)
        share = total / max(1, total.sum()) if weights is None else np.asarray([weights.get(q, 0.0) for q in queues], dtype=float)
        if (share < 0).any():
            raise ValueError("weights are not negative")
        # a queue without a target still has to be emptied; it gets a trickle
        share = np.maximum(share / max(share.sum(), 1e-300), 1e-9)
        return cls(queues, total, share, max(1, round(int(total.sum()) / segment_tokens)))

    def __post_init__(self) -> None:
        self.dry = self.totals / self.weights
        order = np.argsort(self.dry, kind="stable")
        self.knots = np.concatenate([[0.0], self.dry[order]])
        self.done = np.asarray([np.minimum(self.totals, self.weights * v).sum() for v in self.knots])

    def time_of(self, segment: np.ndarray) -> np.ndarray:
        """Virtual time at which a segment begins."""
        tokens = segment * (float(self.totals.sum()) / self.segments)
        return np.interp(tokens, self.done, self.knots)

    def fluid(self, queue: int, segment: np.ndarray) -> np.ndarray:
        return np.minimum(self.totals[queue], self.weights[queue] * self.time_of(segment))

    def first(self, queue: int, segment: np.ndarray) -> np.ndarray:
        """The first token of a queue in a segment."""
        whole = np.floor(self.fluid(queue, segment)).astype(np.int64)
        return np.where(segment >= self.segments, self.totals[queue], np.where(segment <= 0, 0, whole))

    def segments_of(self, queue: int, at: np.ndarray) -> np.ndarray:
        """The segment of each token of a queue."""
        tokens = np.interp(at / self.weights[queue], self.knots, self.done)
        guess = np.clip((tokens * self.segments / max(1.0, float(self.totals.sum()))).astype(np.int64), 0, self.segments - 1)
        while True:
            late = (guess > 0) & (self.first(queue, guess) > at)
            early = (guess < self.segments - 1) & (self.first(queue, guess + 1) <= at)
            if not (late | early).any():
                return guess
            guess = guess - late + early


def pack(
    docs: DataFrame,
    kind: str,
    tokenizer: str,
    end_id: int,
    weights: dict[str, float] | None = None,
    window: int = WINDOW,
    segment_windows: int = SEGMENT_WINDOWS,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece of a document: where it starts and ends in its document and where it lies in its sequence.

    ``docs`` has doc_id, source and text; null text is empty (its end id is packed), null source is a queue of its
    own, repeated rows are packed each, other columns are not read, an empty table gives no rows. ``weights`` maps
    queue names (``=source`` or ``none``) to targets; ``window`` is the number of sequences in which they are met. Each token lies in exactly one piece.
    """
    spark = docs.sparkSession
    tokens = materialize(tokenize(docs, kind, tokenizer, end_id), "packing-tokens")
    sums = tokens.groupBy("queue", "part").agg(F.max(F.col("within") + F.col("n")).alias("n"))
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = materialize(sums.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "packing-sums")
    totals = {r["queue"]: r["n"] for r in before.groupBy("queue").agg(F.sum("n").alias("n")).collect()}
    schedule = Schedule.of(totals, weights, segment_windows * window * LENGTH)
    placed = tokens.join(before.select("queue", "part", "before"), ["queue", "part"])
    placed = placed.select("doc_id", "queue", (F.col("before") + F.col("within")).alias("at"), "n", "ids")
    sent = spark.sparkContext.broadcast(schedule)
    tasks = min(schedule.segments, MOST_TASKS)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = sent.value
        number = {q: i for i, q in enumerate(plan.queues)}
        unpack, pack_ = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            queue = np.asarray([number[q] for q in batch.column("queue").to_pylist()], dtype=np.int64)
            at = batch.column("at").to_numpy(zero_copy_only=False)
            n = batch.column("n").to_numpy(zero_copy_only=False)
            lo, hi = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            for q in np.unique(queue):
                own = queue == q
                lo[own], hi[own] = plan.segments_of(q, at[own]), plan.segments_of(q, at[own] + n[own] - 1)
            out: list[tuple] = []
            doc, ids = batch.column("doc_id").to_pylist(), batch.column("ids")
            for i in range(len(at)):
                q, a, total = int(queue[i]), int(at[i]), int(n[i])
                if lo[i] == hi[i]:
                    out.append((int(lo[i]), q, a, doc[i], 0, total, total, ids[i].as_py()))
                    continue
                data = _wide(_plain(ids[i].as_py(), unpack))
                inner = np.arange(lo[i], hi[i] + 1)
                cuts = [a, *plan.first(q, inner[1:]).tolist(), a + total]
                for segment, x, y in zip(inner.tolist(), cuts, cuts[1:], strict=False):
                    if y > x:
                        part = _stored(_narrow(data[x - a : y - a].tobytes()), pack_)
                        out.append((segment, q, x, doc[i], x - a, y - x, total, part))
            yield batch_of(_DEALT, *zip(*out, strict=True))

    dealt = placed.mapInArrow(tidy(deal), _ddl(_DEALT))
    ordered = dealt.repartitionById(tasks, (F.col("segment") % tasks).cast("int")).sortWithinPartitions("segment", "queue_no", "at")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = sent.value
        segment, rows = None, []
        for row in rows_of(batches):
            if row[0] != segment and rows:
                yield from _fill_segment(plan, segment, rows, window, segment_windows, with_ids)
                rows = []
            segment = row[0]
            rows.append(row)
        if rows:
            yield from _fill_segment(plan, segment, rows, window, segment_windows, with_ids)

    return ordered.mapInArrow(tidy(fill), _ddl(_PIECES))


def windows_of(counts: np.ndarray, account: np.ndarray, capacity: int) -> Iterator[np.ndarray]:
    """Tokens that each queue gives to each window, by deficit round-robin until all queues are empty."""
    left, deficit = counts.astype(np.int64), account.astype(float)
    quantum = capacity * counts / max(1, counts.sum())
    while left.sum() > capacity:
        deficit += quantum
        take = np.clip(np.floor(deficit).astype(np.int64), 0, left)
        rest = capacity - int(take.sum())
        # whole tokens that rounding left over go to, or come from, the queues that are owed most, or least
        while rest:
            step = 1 if rest > 0 else -1
            able = np.flatnonzero(take < left) if step > 0 else np.flatnonzero(take > 0)
            owed = able[np.argsort(-step * (deficit - take)[able], kind="stable")][: abs(rest)]
            # queues that ran dry leave more than rounding: shared out in equal parts
            each = max(1, abs(rest) // max(1, len(able))) if abs(rest) > len(able) else 1
            given = np.minimum(each, (left - take)[owed] if step > 0 else take[owed])
            take[owed] += step * given
            rest -= step * int(given.sum())
        deficit -= take
        left -= take
        yield take
    if left.sum():
        yield left


def sequence_ends(tokens: int) -> list[int]:
    """Ends of the sequences of a stream: full ones, then lengths that are powers of two."""
    ends = list(range(LENGTH, tokens + 1, LENGTH))
    at, rest = tokens - tokens % LENGTH, tokens % LENGTH
    for bit in reversed(range(rest.bit_length())):
        if rest >> bit & 1:
            at += 1 << bit
            ends.append(at)
    return ends


def _fill_segment(
    plan: Schedule, segment: int, rows: list[tuple], window: int, segment_windows: int, with_ids: bool
) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    size = len(plan.queues)
    queues: list[list[tuple]] = [[] for _ in range(size)]
    counts = np.zeros(size, np.int64)
    for _, q, _, doc, start, n, total, stored in rows:
        queues[q].append((doc, start, n, total, stored))
        counts[q] += n
    edge = np.asarray([segment])
    account = np.asarray([float((plan.fluid(q, edge) - plan.first(q, edge))[0]) for q in range(size)])
    ends = sequence_ends(int(counts.sum()))
    stride = 2 * segment_windows * window + 64 + size
    if len(ends) > stride:
        raise ValueError("a segment has more sequences than its numbers allow")
    place, used, data = [0] * size, [0] * size, [None] * size
    at, sequence, out = 0, 0, []
    for number, take in enumerate(windows_of(counts, account, window * LENGTH)):
        turn = (segment * segment_windows + number) % size
        for q in [*range(turn, size), *range(turn)]:
            due = int(take[q])
            while due:
                doc, start, n, total, stored = queues[q][place[q]]
                if data[q] is None:
                    data[q] = _wide(_plain(stored, unpack))
                begin = ends[sequence - 1] if sequence else 0
                length = min(due, n - used[q], ends[sequence] - at)
                ids = data[q][used[q] : used[q] + length].tobytes()
                out.append(
                    (doc, start + used[q], length, zlib.crc32(ids), total, segment * stride + sequence, at - begin)
                    + (plan.queues[q], segment * (2 * segment_windows + size + 1) + number, ids if with_ids else None)
                )
                at, due, used[q] = at + length, due - length, used[q] + length
                if at == ends[sequence]:
                    sequence += 1
                if used[q] == n:
                    place[q], used[q], data[q] = place[q] + 1, 0, None
            if len(out) >= 5_000:
                yield batch_of(_PIECES, *zip(*out, strict=True))
                out = []
    if out:
        yield batch_of(_PIECES, *zip(*out, strict=True))


def pad_to(length: int) -> int:
    """Length of a sequence in memory: itself where it is a power of two, else ``LENGTH``."""
    return length if length & (length - 1) == 0 else LENGTH
