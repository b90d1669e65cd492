"""Language identification by prediction by partial matching.

Every language has a tree of byte contexts of up to three bytes with the counts of the bytes that followed. A byte
costs ``-log2 p`` bits, where ``p`` comes from the longest context the tree knows: a context seen ``n`` times with
``d`` different followers gives a follower seen ``c`` times ``c / (n + d)`` and the escape to the next shorter
context ``d / (n + d)``; below the empty context all symbols are alike. Statistics are frozen after learning, so the
code length of a text is a plain sum over its bytes, exact and the same in any order of reading. The language with
the shortest code wins (ties: the first in alphabetical order).

Text is lower-cased; ASCII bytes other than letters count as one separator byte. The ``ALPHABET`` most frequent
bytes are symbols of their own, all others share one.

Learning counts four-byte sequences over all given labelled texts, in the tasks first, so only counts are shuffled.
The model holds all counted (language, sequence) pairs, none is left out: it grows with the different sequences of the
languages, not with the rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdure.llm.chunks import groups
from verdure.llm.common import batch_of
from verdure.llm.memory import give_back, per_worker, tidy

ORDER = 3
ALPHABET = 63
UNDETERMINED = "und"
#: Bytes handled at once; bounds the memory of a task.
BLOCK = 1_000_000

_LETTER = regex.compile(r"\p{L}")
_FOLD = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))
_PAD = b" " * ORDER
_SEPARATOR = 0x20

_COUNTS = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
_SCORES = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("bits_per_byte", pa.float64())])


def folded(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace").translate(_FOLD)


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def grams_of(data: bytes) -> np.ndarray:
    """Four-byte sequences that end at each byte of ``data`` after the padding."""
    x = np.frombuffer(data, np.uint8).astype(np.uint32)
    return (x[:-3] << 24) | (x[1:-2] << 16) | (x[2:-1] << 8) | x[3:]


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of ``labelled`` (lang, text) that have both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for rows, texts in groups(batches):
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(rows.column("lang").to_pylist(), texts, strict=True):
                if text:
                    by_lang.setdefault(lang, []).append(folded(text))
            for lang, parts in by_lang.items():
                grams, n = np.unique(grams_of(_PAD + _PAD.join(parts)), return_counts=True)
                if lang in seen:
                    old, m = seen[lang]
                    both = np.concatenate([old, grams])
                    grams, where = np.unique(both, return_inverse=True)
                    n = np.bincount(where, np.concatenate([m, n])).astype(np.int64)
                seen[lang] = grams, n
        for lang, (grams, n) in seen.items():
            for at in range(0, len(grams), 100_000):
                part = slice(at, at + 100_000)
                yield batch_of(_COUNTS, [lang] * len(grams[part]), grams[part].astype(np.int64), n[part].astype(np.int64))

    known = labelled.select(F.col("lang").cast("string"), F.col("text").cast("string")).where("lang is not null and text is not null")
    counted = known.mapInArrow(tidy(run), "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Frozen counts of all sequences, sent to every worker."""

    key: str
    languages: list[str]
    lang: np.ndarray
    gram: np.ndarray
    n: np.ndarray


def fit(labelled: DataFrame) -> Model:
    counted = gram_counts(labelled).toArrow()
    languages = sorted(counted.column("lang").unique().to_pylist())
    lang = pc.index_in(counted.column("lang"), pa.array(languages, pa.string())).to_numpy().astype(np.int32)
    gram, n = (counted.column(c).to_numpy().astype(np.int64) for c in ("gram", "n"))
    # the same layout whatever order the counts came in
    order = np.lexsort((gram, lang))
    return Model(uuid.uuid4().hex, languages, lang[order], gram[order], n[order])


class Trees:
    """The code length of every symbol after every context, laid out as tables."""

    def __init__(self, model: Model):
        quads = np.stack([(model.gram >> s) & 255 for s in (24, 16, 8, 0)])
        frequency = np.bincount(quads[3], model.n, 256)
        frequency[_SEPARATOR] = np.inf
        common = [b for b in np.argsort(-frequency, kind="stable")[:ALPHABET] if frequency[b] > 0]
        self.symbol = np.full(256, len(common), np.uint8)
        self.symbol[common] = np.arange(len(common))
        self.a = a = len(common) + 1
        symbols = self.symbol[quads].astype(np.int64)
        code = ((symbols[0] * a + symbols[1]) * a + symbols[2]) * a + symbols[3]
        used, where = np.unique(code, return_inverse=True)
        self.row = np.zeros(a**4, np.int32)
        self.row[used] = np.arange(1, len(used) + 1)
        self.long, self.escape, self.short = [], [], []
        for i in range(len(model.languages)):
            own = model.lang == i
            counts = np.bincount(where[own], model.n[own], len(used))
            self._language(used, counts)

    def _language(self, used: np.ndarray, counts: np.ndarray) -> None:
        a = self.a
        cost = np.full(a, np.log2(a))
        for order in range(3):
            # contexts of ``order`` symbols: the last order + 1 symbols of every sequence
            size = a ** (order + 1)
            seen = np.bincount(used % size, counts, size).reshape(-1, a)
            cost = self._blend(seen, np.tile(cost.reshape(-1, a), (len(seen) // max(1, cost.size // a), 1)))
        self.short.append(cost.ravel())
        total = np.bincount(used // a, counts, a**3)
        different = np.bincount(used // a, counts > 0, a**3)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, -np.log2(different / (total + different)), 0.0)
            direct = -np.log2(counts / (total + different)[used // a])
        below = escape[used // a] + self.short[-1][used % a**3]
        self.long.append(np.concatenate([[0.0], np.where(counts > 0, direct, below)]))
        self.escape.append(escape)

    @staticmethod
    def _blend(seen: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        n, d = seen.sum(axis=1, keepdims=True), (seen > 0).sum(axis=1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            direct = -np.log2(seen / (n + d))
            escape = np.where(n > 0, -np.log2(d / (n + d)), 0.0)
        return np.where(seen > 0, direct, escape + shorter)

    def bits(self, parts: list[bytes]) -> np.ndarray:
        """Code length in bits of every part (row) under every language (column)."""
        out = np.zeros((len(parts), len(self.long)))
        pieces = [(i, p[max(0, at - ORDER) : at] if at else _PAD, p[at : at + BLOCK]) for i, p in enumerate(parts) for at in range(0, len(p), BLOCK)]
        at = 0
        while at < len(pieces):
            end, size = at, 0
            while end < len(pieces) and size < BLOCK:
                size += len(pieces[end][2])
                end += 1
            self._add(out, pieces[at:end])
            at = end
        return out

    def _add(self, out: np.ndarray, pieces: list[tuple[int, bytes, bytes]]) -> None:
        a = self.a
        x = self.symbol[np.frombuffer(b"".join([c + p for _, c, p in pieces]), np.uint8)].astype(np.int32)
        code = ((x[:-3] * a + x[1:-2]) * a + x[2:-1]) * a + x[3:]
        row = self.row[code]
        rare = np.flatnonzero(row == 0)
        context, tail = code[rare] // a, code[rare] % a**3
        # the first byte of a piece ends the sequence that starts with its context
        lengths = np.asarray([len(p) + ORDER for _, _, p in pieces])
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        edges = np.stack([first, np.minimum(first + lengths - ORDER, len(code))], axis=1).ravel()
        owner = np.asarray([i for i, _, _ in pieces])
        for k, (long, escape, short) in enumerate(zip(self.long, self.escape, self.short, strict=True)):
            cost = long[row]
            cost[rare] = escape[context] + short[tail]
            sums = np.add.reduceat(np.append(cost, 0.0), edges)[::2]
            np.add.at(out[:, k], owner, sums)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, bits_per_byte) of every row of ``docs`` (doc_id, text).

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned. ``score`` is the share of
    the chosen language among ``2 ** -bits`` of all. Empty tables give empty results; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = sent.value
        trees = per_worker("ppm", learned.key, lambda: Trees(learned)) if learned.languages else None
        for rows, texts in groups(batches):
            names, scores, rates = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
            told = [i for i, t in enumerate(texts) if has_letter(t)] if trees else []
            if told:
                parts = [folded(texts[i]) for i in told]
                bits = trees.bits(parts)
                best = bits.argmin(axis=1)
                least = bits.min(axis=1)
                scores[told] = 1 / np.exp2(least[:, None] - bits).sum(axis=1)
                rates[told] = least / [len(p) for p in parts]
                for i, k in zip(told, best, strict=True):
                    names[i] = learned.languages[k]
            yield batch_of(_SCORES, rows.column("doc_id"), names, scores, rates)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidy(run), "doc_id long, lang_pred string, score double, bits_per_byte double"
    )


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fold that learning leaves out; a missing id is in neither."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the labelled documents outside the held-out fold and predict all documents."""
    learn = docs.where(~held_out() & F.col("doc_id").isNotNull()).select("lang", "text")
    return predict(docs, fit(learn)).withColumn("held_out", held_out())


#: A document whose best language has a smaller share than this is rejected.
LEAST_SCORE = 0.5


def keep_identified(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """``docs`` (doc_id, text, lang and any others) without those whose language cannot be told; columns stay.

    Where nothing was learned, no document is rejected.
    """
    learn = docs.where(~held_out() & F.col("doc_id").isNotNull()).select("lang", "text")
    model = fit(learn)
    if not model.languages:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def kept(text: pa.Array) -> pa.Array:
        learned = sent.value
        texts = [t.as_py() for t in text]
        out = np.zeros(len(texts), bool)
        told = [i for i, t in enumerate(texts) if has_letter(t)]
        if told:
            trees = per_worker("ppm", learned.key, lambda: Trees(learned))
            bits = trees.bits([folded(texts[i]) for i in told])
            out[told] = 1 / np.exp2(bits.min(axis=1)[:, None] - bits).sum(axis=1) >= least
        give_back()
        return pa.array(out)

    return docs.where(kept(F.col("text").cast("string")))
