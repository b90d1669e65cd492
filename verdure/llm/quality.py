"""Quality classification by co-training on two views of a document.

The *text view* are figures about the characters, words and lines of the whole text; the *page view* is the metadata:
language, source and stated length. Each view has a logistic model. Both start from labelled rows. In every round each
model scores all documents without a label; those it is most sure of, ``EXCHANGED`` of either class, get its answer as
a pseudo-label and join the other model's examples. Afterwards a fold of labelled rows that no model has seen calibrates
each view, and the calibrated views are weighed into one probability, so a view that tells little gets little weight.

Labelled examples are a bounded sample, ``LABELLED`` rows chosen by hash; every document is described, scored in every
round and scored at the end. Without labels of both classes all documents score 0.5 and are kept.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdure.llm.common import batch_of
from verdure.llm.memory import forget, give_back, tidy
from verdure.session import materialize

LABELLED = 20_000
ROUNDS = 3
#: Pseudo-labels of each class that a view hands over per round, and how sure it has to be.
EXCHANGED = 500
SURE = 0.95
KEEP = 0.5
RIDGE = 1e-2

_SOURCES, _LANGUAGES = 32, 16
PAGE_SIZE = 3 + _SOURCES + _LANGUAGES
_UPPER = np.arange(65, 91)
_LOWER = np.arange(97, 123)
_DIGITS = np.arange(48, 58)
_SIGNS = np.asarray([b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'\"()-?!"])
_MARKS = np.frombuffer(b"!?", np.uint8)
TEXT_SIZE = 15


def text_view(text: str | None) -> list[float]:
    """Figures of a whole text; null is empty."""
    data = (text or "").encode("utf-8", "replace")
    n = len(data)
    if not n:
        return [0.0] * TEXT_SIZE
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = count / n
    seen = share[share > 0]
    words = data.split()
    k = max(1, len(words))
    different = len(set(words))
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    lines = data.split(b"\n")
    letters = max(1, int(count[_UPPER].sum() + count[_LOWER].sum()))
    return [
        np.log1p(n),
        float(count[_UPPER].sum()) / letters,
        float(share[_DIGITS].sum()),
        float(share[_SIGNS].sum()),
        float(share[_MARKS].sum()),
        float(share[128:].sum()),
        float(share[32]),
        len(lines) / n,
        float(-(seen * np.log2(seen)).sum()),
        n / k,
        # distinct words, measured against what a text of this length usually has
        different / k**0.8,
        repeats / k,
        1 - len(set(lines)) / len(lines),
        float(share[np.frombuffer(b"|", np.uint8)].sum()),
        float(share[_SIGNS].max()),
    ]


def page_view(lang: str | None, source: str | None, n_chars: int | None) -> list[float]:
    """Metadata as numbers; names fall into a fixed number of bins, a missing value into a bin of its own."""
    out = [0.0] * PAGE_SIZE
    stated = max(0, n_chars) if n_chars is not None else 0
    out[0], out[1], out[2] = float(n_chars is None), float(np.log1p(stated)), float(np.log1p(stated)) ** 2 / 10
    out[3 + (zlib.crc32(source.encode()) % (_SOURCES - 1) + 1 if source is not None else 0)] = 1.0
    out[3 + _SOURCES + (zlib.crc32(lang.encode()) % (_LANGUAGES - 1) + 1 if lang is not None else 0)] = 1.0
    return out


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Logistic:
    """A ridge logistic model on standardised figures."""

    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.ones(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, steps: int = 25) -> Logistic:
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale[scale < 1e-9] = 1.0
        z = np.hstack([np.clip((x - mean) / scale, -8, 8), np.ones((len(x), 1))])
        ridge = RIDGE * len(x) ** 0.5 * np.eye(z.shape[1])
        ridge[-1, -1] = 1e-6
        w = np.zeros(z.shape[1])
        for _ in range(steps):
            p = _logistic(z @ w)
            gradient = z.T @ (y - p) - ridge @ w
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge + 1e-9 * np.eye(len(w)), gradient)
            w = w + step * min(1.0, 5 / max(1e-12, np.abs(step).max()))
            if np.abs(step).max() < 1e-6:
                break
        return cls(mean, scale, w)

    def logit(self, x: np.ndarray) -> np.ndarray:
        if not len(self.mean):
            return np.zeros(len(x))
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights[:-1] + self.weights[-1]


@dataclass
class Model:
    """Two views, the calibration of each and their weights."""

    text: Logistic = field(default_factory=Logistic)
    page: Logistic = field(default_factory=Logistic)
    calibrate: tuple[Logistic, Logistic] | None = None
    blend: Logistic | None = None
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def scores(self, text: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good quality by each calibrated view and by both."""
        if self.blend is None:
            half = np.full(len(text), 0.5)
            return half, half, half
        views = [c.logit(v.logit(x)[:, None]) for c, v, x in zip(self.calibrate, (self.text, self.page), (text, page), strict=True)]
        return _logistic(views[0]), _logistic(views[1]), _logistic(self.blend.logit(np.stack(views, axis=1)))


_VIEWS = pa.schema([("doc_id", pa.int64()), ("text_view", pa.list_(pa.float64())), ("page_view", pa.list_(pa.float64()))])


def describe(docs: DataFrame) -> DataFrame:
    """(doc_id, text_view, page_view) of every row of ``docs`` (doc_id, text, lang, source, n_chars)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lang, source, n = (part.column(c).to_pylist() for c in ("lang", "source", "n_chars"))
                text = [text_view(t.as_py()) for t in part.column("text")]
                page = [page_view(*m) for m in zip(lang, source, n, strict=True)]
                yield batch_of(_VIEWS, part.column("doc_id"), text, page)

    return _read(docs).mapInArrow(tidy(run), "doc_id long, text_view array<double>, page_view array<double>")


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"), F.col("source").cast("string"), F.col("n_chars").cast("long")
    )


def _matrix(rows: pa.Table, name: str, width: int) -> np.ndarray:
    flat = rows.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False) if rows.num_rows else np.zeros(0)
    return flat.reshape(rows.num_rows, width)


def _sample(rows: DataFrame, count: int) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    picked = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(count).toArrow()
    return _matrix(picked, "text_view", TEXT_SIZE), _matrix(picked, "page_view", PAGE_SIZE), picked


def train(views: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS, exchanged: int = EXCHANGED) -> Model:
    """Co-training on described documents; a document with several labels has the one most rows give (ties: good)."""
    told = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("double")).where("doc_id is not null and quality is not null")
    told = told.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("good"))
    text, page, picked = _sample(views.join(told, "doc_id"), labelled)
    good = picked.column("good").to_numpy().astype(float)
    # every fourth example calibrates and is never learned from
    fold = np.arange(len(good)) % 4 == 3
    if min(len(set(good[~fold])), len(set(good[fold]))) < 2:
        return Model()
    sets = {"text": [(text[~fold], good[~fold])], "page": [(page[~fold], good[~fold])]}

    def fitted(view: str) -> Logistic:
        return Logistic.fit(np.concatenate([x for x, _ in sets[view]]), np.concatenate([y for _, y in sets[view]]))

    model = Model(fitted("text"), fitted("page"))
    unlabelled = materialize(views.where("doc_id is not null").join(told, "doc_id", "left_anti"), "quality-unlabelled") if rounds else None
    for _ in range(rounds):
        handed = _confident(unlabelled, model, exchanged)
        if not len(handed[0][2]) and not len(handed[1][2]):
            break
        # each view teaches the other
        (_, page_x, by_text), (text_x, _, by_page) = handed
        sets["page"] = sets["page"][:1] + [(page_x, by_text)]
        sets["text"] = sets["text"][:1] + [(text_x, by_page)]
        model = Model(fitted("text"), fitted("page"))
    views_out = [v.logit(x[fold])[:, None] for v, x in ((model.text, text), (model.page, page))]
    model.calibrate = tuple(Logistic.fit(v, good[fold]) for v in views_out)
    both = np.stack([c.logit(v) for c, v in zip(model.calibrate, views_out, strict=True)], axis=1)
    model.blend = Logistic.fit(both, good[fold])
    return model


def _confident(unlabelled: DataFrame, model: Model, count: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """What each view is most sure of among all unlabelled documents: text figures, page figures, answers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            answers = [_logistic(model.text.logit(_matrix(rows, "text_view", TEXT_SIZE))), _logistic(model.page.logit(_matrix(rows, "page_view", PAGE_SIZE)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(a) for a in answers)], names=[*batch.schema.names, "by_text", "by_page"])

    scored = unlabelled.select("doc_id", "text_view", "page_view").mapInArrow(tidy(run), "doc_id long, text_view array<double>, page_view array<double>, by_text double, by_page double"
    )
    scored = materialize(scored.where(f"greatest(by_text, by_page) >= {SURE} or least(by_text, by_page) <= {1 - SURE}"), "quality-sure")
    out = []
    for view in ("by_text", "by_page"):
        parts = []
        for answer, sure in ((1.0, F.col(view) >= SURE), (0.0, F.col(view) <= 1 - SURE)):
            # ties and near ties are many: the hash decides among equally sure ones
            order = [F.round(F.col(view), 2).desc() if answer else F.round(F.col(view), 2), F.xxhash64("doc_id"), F.col("doc_id")]
            rows = scored.where(sure).orderBy(*order).limit(count).toArrow()
            parts.append((_matrix(rows, "text_view", TEXT_SIZE), _matrix(rows, "page_view", PAGE_SIZE), np.full(rows.num_rows, answer)))
        out.append(tuple(np.concatenate(x) for x in zip(*parts, strict=True)))
    return out


def score(views: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text_score, page_score, score, keep) of every described document."""
    schema = pa.schema([("doc_id", pa.int64()), *((n, pa.float64()) for n in ("text_score", "page_score", "score")), ("keep", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            found = model.scores(_matrix(rows, "text_view", TEXT_SIZE), _matrix(rows, "page_view", PAGE_SIZE))
            yield batch_of(schema, batch.column("doc_id"), *found, found[2] >= KEEP)

    return views.mapInArrow(tidy(run), "doc_id long, text_score double, page_score double, score double, keep boolean")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text_score, page_score, score, keep) for every row of ``docs``.

    Null text is empty, null metadata has bins of its own, rows without a doc_id are scored but never learned from,
    repeated rows are scored each, other columns are not read, an empty table gives no rows.
    """
    views = materialize(describe(docs), "quality-views")
    return score(views, train(views, labels))


def accepts(model: Model) -> Column:
    """Whether a document is kept, as a column over text, lang, source and n_chars."""

    @F.arrow_udf("boolean")
    def kept(text: pa.Array, lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> pa.Array:
        views = np.asarray([text_view(t.as_py()) for t in text]).reshape(len(text), TEXT_SIZE)
        pages = np.asarray([page_view(*m) for m in zip(lang.to_pylist(), source.to_pylist(), n_chars.to_pylist(), strict=True)]).reshape(len(text), PAGE_SIZE)
        give_back()
        return pa.array(model.scores(views, pages)[2] >= KEEP)

    return kept(F.col("text").cast("string"), F.col("lang").cast("string"), F.col("source").cast("string"), F.col("n_chars").cast("long"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those that the classifier rejects; columns stay."""
    views = materialize(describe(docs), "quality-views")
    return docs.where(accepts(train(views, labels)))
