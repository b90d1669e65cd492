"""Toxicity by averaged subword vectors and a linear softmax, trained jointly.

A word stands for itself and for its character n-grams (``NGRAMS``, with marks at both ends), hashed into ``BUCKETS`` rows
of an embedding table, so a misspelled or extended word that training never met still shares most of its rows with the
words it comes from. A subword counts by ``RARE / (RARE + share of texts that have it)``, and not at all below
``LEAST_TEXTS`` texts of the sample. A word's vector is the mean over its subwords; a text's vector is the mean over its
different words, each by the logarithm of its count, and ``BLANKS`` neutral words, so a few odd words do not settle a tiny
text. A linear softmax over it gives the probability. Table and softmax are learned together by mini-batch gradient
descent with a falling rate, in numpy.

Learning takes a bounded, documented sample of the labelled rows: of either label the ``LABELLED`` first by hash, as far as
their bags hold ``LABELLED_ENTRIES`` entries in all. Bags of the sampled rows come from whole texts, in tasks. As everything after the
table is linear, the model folds down to one number per bucket, with which all whole texts are scored.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdure.llm.common import batch_of
from verdure.llm.memory import Memory, forget, per_worker, tidy
from verdure.session import materialize

NGRAMS = (3, 4, 5)
BUCKETS = 1 << 18
WIDTH = 8
RARE, LEAST_TEXTS, BLANKS = 0.05, 5, 10
LABELLED, LABELLED_ENTRIES = 3_000, 10_000_000
#: Gradients of the table are as small as a subword's share of a text, hence its rate.
EPOCHS, BATCH, RATE, SOFTMAX_RATE = 10, 32, 20_000.0, 0.05
_WORDS = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits, in lower case; null is empty."""
    return _WORDS.findall(text.lower()) if text else []


def subwords(word: str) -> list[int]:
    """Buckets of a word and of its n-grams; never empty."""
    marked = f"<{word}>"
    grams = [marked[i : i + n] for n in NGRAMS if n < len(marked) for i in range(len(marked) - n + 1)]
    return [zlib.crc32(g.encode("utf-8", "replace")) % BUCKETS for g in (marked, *grams)]


def weighed(words: list[str]) -> tuple[dict[str, float], float]:
    """The different words and the weight of each, and what the sum over them is divided by."""
    weights = {w: math.log2(1 + k) for w, k in Counter(words).items()}
    return weights, sum(weights.values()) + BLANKS


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a whole text and the share of each."""
    weights, total = weighed(words_of(text))
    if not weights:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    ids = [subwords(w) for w in weights]
    shares = np.repeat([k / len(own) / total for k, own in zip(weights.values(), ids, strict=True)], [len(own) for own in ids])
    buckets, place = np.unique(np.concatenate(ids), return_inverse=True)
    return buckets.astype(np.int32), np.bincount(place, shares).astype(np.float32)


@dataclass
class Model:
    """One logit per bucket, what the softmax adds, and the share of label 1, which texts without words get."""

    table: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS))
    bias: float = 0.0
    prior: float = 0.0
    learned: bool = False
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def word_logits(self, words: list[str]) -> list[float]:
        return [float(self.table[subwords(w)].mean()) for w in words]

    def score(self, words: list[str], logits: dict[str, float]) -> float:
        """Probability of label 1 of a text with these words, each with its logit."""
        if not self.learned or not words:
            return self.prior
        weights, total = weighed(words)
        z = sum(k * logits[w] for w, k in weights.items()) / total + self.bias
        return 1 / (1 + math.exp(-min(max(z, -500.0), 500.0)))


def fit(bags: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, prior: float = 0.0, epochs: int = EPOCHS, seed: int = 0) -> Model:
    """Embedding table and softmax, learned jointly; the same input gives the same model. Weighs ``bags`` in place."""
    texts = np.zeros(BUCKETS, np.int64)
    for ids, _ in bags:
        texts[ids] += 1
    use = np.where(texts >= LEAST_TEXTS, RARE / (RARE + texts / max(1, len(bags))), 0).astype(np.float32)
    for i, (ids, share) in enumerate(bags):
        met = use[ids] > 0
        bags[i] = ids[met], share[met] * use[ids[met]]
    used = np.asarray([i for i, b in enumerate(bags) if len(b[0])], dtype=np.int64)
    if len(set(y[used].tolist())) < 2:
        return Model(prior=prior)
    rng = np.random.default_rng(seed)
    table = rng.uniform(-0.1, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    soft = rng.uniform(-0.5, 0.5, (WIDTH, 2)).astype(np.float32)
    toxic = float(y[used].mean())
    bias = np.log(np.asarray([1 - toxic, toxic], dtype=np.float32))
    one_hot = np.eye(2, dtype=np.float32)[y.astype(int)]
    # both classes pull alike
    pull = np.where(y == 1, 0.5 / toxic, 0.5 / (1 - toxic)).astype(np.float32)
    steps, step = epochs * -(-len(used) // BATCH), 0
    for _ in range(epochs):
        order = rng.permutation(used)
        for at in range(0, len(order), BATCH):
            own, falling, step = order[at : at + BATCH], 1 - step / steps, step + 1
            ids = np.concatenate([bags[i][0] for i in own])
            share = np.concatenate([bags[i][1] for i in own])
            sizes = np.asarray([len(bags[i][0]) for i in own])
            firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            mean = np.add.reduceat(table[ids] * share[:, None], firsts, axis=0)
            logits = mean @ soft + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            error = (p - one_hot[own]) * pull[own, None] / len(own)
            met, place = np.unique(ids, return_inverse=True)
            back = np.repeat(error @ soft.T, sizes, axis=0) * share[:, None]
            table[met] -= RATE * falling * np.stack([np.bincount(place, back[:, j], len(met)) for j in range(WIDTH)], axis=1).astype(np.float32)
            soft -= SOFTMAX_RATE * falling * (mean.T @ error)
            bias -= SOFTMAX_RATE * falling * error.sum(axis=0)
    return Model((use * (table @ (soft[:, 1] - soft[:, 0]))).astype(np.float64), float(bias[1] - bias[0]), prior, True)


_BAGS = pa.schema([("order", pa.int64()), ("doc_id", pa.int64()), ("toxic", pa.int32()), ("ids", pa.list_(pa.int32())), ("share", pa.list_(pa.float32()))])


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    for batch in batches:
        for at in range(0, batch.num_rows, 100):
            part = batch.slice(at, 100)
            found = [bag(t.as_py()) for t in part.column("text")]
            yield batch_of(_BAGS, part.column("order"), part.column("doc_id"), part.column("toxic"), [f[0] for f in found], [f[1] for f in found])


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, entries: int = LABELLED_ENTRIES) -> Model:
    """Learn from the rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) marks.

    A document with several labels has the one most rows give (ties: toxic). Rows without a doc_id teach nothing; of rows
    that repeat an id the first texts in UTF-8 order are taken, like any other row.
    """
    told = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("double").alias("toxic")).where("doc_id is not null and toxic is not null")
    told = told.groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    # ids first: texts are fetched for the sampled rows only
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null")
    known = materialize(ids.join(told, "doc_id").select("doc_id", "toxic", F.xxhash64("doc_id").alias("order")).distinct(), "toxic-labelled")
    first = [known.where(F.col("toxic") == label).orderBy("order", "doc_id").limit(labelled) for label in (0, 1)]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    one = texts.join(F.broadcast(first[0].unionByName(first[1])), "doc_id").groupBy("doc_id", "toxic", "order").agg(F.min("text").alias("text"))
    bags = one.select("order", "doc_id", "toxic", "text").mapInArrow(tidy(_bags), "order long, doc_id long, toxic int, ids array<int>, share array<float>")
    # at most twice ``labelled`` rows meet in this window
    upto = F.sum(F.size("ids")).over(Window.orderBy("order", "doc_id"))
    rows = bags.withColumn("upto", upto).where(F.col("upto") <= entries).select("ids", "share", "toxic").toArrow()
    arrays = [_arrays(rows.column(c)) for c in ("ids", "share")]
    prior = known.agg(F.avg("toxic")).first()[0] or 0.0
    return fit(list(zip(*arrays, strict=True)), rows.column("toxic").to_numpy(), prior)


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for chunk in column.chunks:
        offsets, flat = chunk.offsets.to_numpy(), chunk.values.to_numpy(zero_copy_only=False)
        out += [flat[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    return out


_SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def scored(docs: DataFrame, model: Model, held_out: Column) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``, over whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = per_worker("toxicity", model.key, lambda: Memory(model.word_logits))
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                words = [words_of(t.as_py()) for t in part.column("text")]
                different = [list(set(w)) for w in words]
                logits = memory.values(different)
                scores = [model.score(w, dict(zip(d, v, strict=True))) for w, d, v in zip(words, different, logits, strict=True)]
                yield batch_of(_SCORES, part.column("doc_id"), part.column("held_out"), scores, [int(s >= 0.5) for s in scores])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out.alias("held_out"))
    return rows.mapInArrow(tidy(run), "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, held_out: Column | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text); rows ``held_out`` are never learned from.

    Scores come from the text alone. A text without words (null, empty, signs) gets the share of toxic rows among those
    learned from, 0 where there are none; so does every text where the sample holds no label of one kind. Rows that repeat
    are scored each, other columns are not read, an empty table gives no rows.
    """
    held = held_out if held_out is not None else F.lit(False)
    return scored(docs, train(docs.where(~held), labels), held)
