"""Byte-pair encoding as a deterministic automaton over tokens.

The automaton reads tokens and accepts exactly the token sequences that the merge rules produce. It starts with
one state per base symbol, all arcs present. The rules are then applied in their order, each by one merge gadget;
for the rule ``a b -> c``:

* ``c`` gets a state that copies the arcs of the state of ``b``,
* every state that has an arc ``a`` gets an arc ``c`` too (but not the state of ``a`` itself where a = b),
* the state of ``a`` loses its arc ``b``.

An arc always leads to the state of its token, so a state is named by the token that entered it. Copies share the
rows of their origin: a gadget notes where a state and an arc came from and when an arc was taken away, and
``has_arc`` resolves a pair through these notes once and keeps the answer in the transition table.

Every prefix of a word has exactly one accepted token sequence, so a word is encoded from left to right by table
lookups: a trie gives the tokens that begin at a reached position, the transition table those that may follow there.
Decoding writes the labels of the arcs.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdure.llm.chunks import Coder, byte_symbols, groups, little_endian
from verdure.llm.common import batch_of, sha256_hex
from verdure.llm.memory import Memory, per_worker, tidy
from verdure.llm.plain import PlainCoder

#: Resolved pairs kept in a worker's transition table before it starts anew.
ARCS_KEPT = 2_000_000

BASE = -1  # made by no gadget


class Automaton:
    """The compiled merges; ``end`` marks the last symbol of a word and may be empty."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], end: str = ""):
        size = max(vocabulary.values()) + 1
        self.label = [""] * size
        for token, i in vocabulary.items():
            self.label[i] = token
        self.made, self.left, self.right = [BASE] * size, [BASE] * size, [BASE] * size
        self.removed: dict[tuple[int, int], int] = {}
        self.live = [True] * size
        self.arcs: dict[int, bool] = {}
        self.size = size
        for rank, (a, b) in enumerate(merges):
            self._gadget(rank, vocabulary[a], vocabulary[b], vocabulary[a + b])
        self._trie(vocabulary, end)

    def _gadget(self, rank: int, a: int, b: int, c: int) -> None:
        if self.made[c] != BASE or (a, b) in self.removed:
            raise ValueError(f"{self.label[c]!r} is made by two rules")
        # a pair that earlier rules keep apart gives the new token no arcs
        self.live[c] = self.live[a] and self.live[b] and self._resolve(a, b, rank)
        self.made[c], self.left[c], self.right[c] = rank, a, b
        self.removed[(a, b)] = rank

    def _resolve(self, state: int, token: int, before: int) -> bool:
        """Whether ``state`` has an arc ``token`` when the gadgets before rank ``before`` are in place."""
        made, removed = self.made, self.removed
        while True:
            gone = removed.get((state, token))
            if gone is not None and gone < before:
                return False
            if made[state] >= made[token]:
                if made[state] == BASE:
                    return True
                before, state = min(before, made[state]), self.right[state]
            else:
                before, token = min(before, made[token] + 1), self.left[token]

    def has_arc(self, state: int, token: int) -> bool:
        key = state * self.size + token
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) > ARCS_KEPT:
                self.arcs.clear()
            known = self.arcs[key] = self._resolve(state, token, len(self.removed) + 1)
        return known

    def _trie(self, vocabulary: dict[str, int], end: str) -> None:
        """step[node << 9 | symbol] = next node; symbols above 255 are bytes that end a word."""
        symbols = byte_symbols()
        code = {s: b for b, s in enumerate(symbols)}
        lacking = [s + e for s in symbols for e in {"", end} if s + e not in vocabulary]
        if lacking:
            raise ValueError(f"the vocabulary lacks base symbols, such as {lacking[0]!r}")
        self.step: dict[int, int] = {}
        self.token_at = [BASE]
        self.ends = 256 if end else 0
        for token, i in vocabulary.items():
            closed = bool(end) and token.endswith(end)
            text = token[: -len(end)] if closed else token
            if not text or not self.live[i] or any(ch not in code for ch in text):
                continue
            node = 0
            for k, ch in enumerate(text):
                symbol = code[ch] + (256 if closed and k == len(text) - 1 else 0)
                key = node << 9 | symbol
                if key not in self.step:
                    self.step[key] = len(self.token_at)
                    self.token_at.append(BASE)
                node = self.step[key]
            self.token_at[node] = i

    def encode(self, word: bytes) -> list[int]:
        """The tokens of one pre-split word."""
        n = len(word)
        if not n:
            return []
        symbols = list(word)
        symbols[-1] += self.ends
        state, origin = [BASE] * (n + 1), [0] * (n + 1)
        step, token_at, arcs, size = self.step, self.token_at, self.arcs, self.size
        for i in range(n):
            here, node = state[i], 0
            for j in range(i, n):
                node = step.get(node << 9 | symbols[j])
                if node is None:
                    break
                token = token_at[node]
                if token < 0 or state[j + 1] != BASE:
                    continue
                if i:
                    known = arcs.get(here * size + token)
                    if known is None:
                        known = self.has_arc(here, token)
                    if not known:
                        continue
                state[j + 1], origin[j + 1] = token, i
        tokens, at = [], n
        while at:
            tokens.append(state[at])
            at = origin[at]
        tokens.reverse()
        return tokens


class WordTokenizer:
    """A tokenizer file with lower-cased words and word ends, read into an automaton.

    Reads the file's own normalisation (NFC, white space, lower case letter by letter), its splitting pattern, its
    special tokens and its merges.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        labels = {i: t for i, t in enumerate(self.automaton.label)} | {i: t for t, i in self.special.items()}
        self.labels = [labels[i].encode() for i in range(max(labels) + 1)]
        self.chunks = Memory(lambda keys: [little_endian(self._chunk(k)) for k in keys])
        plain = PlainCoder(False, True, lambda words: [little_endian(self.automaton.encode(w)) for w in words])
        self.encode = Coder(plain, self._general)

    def _chunk(self, chunk: str) -> list[int]:
        ids: list[int] = []
        for part in self.split.split(chunk):
            if part in self.special:
                ids.append(self.special[part])
                continue
            text = part if part.isascii() else unicodedata.normalize("NFC", part)
            text = text.lower() if text.isascii() else "".join([c.lower() for c in text])
            for word in self.words.findall(text):
                ids += self.automaton.encode(word.encode())
        return ids

    def _general(self, texts: list[str]) -> list[bytes]:
        """Ids of texts of any kind; chunks between spaces are encoded once."""
        return [b"".join(ids) for ids in self.chunks.values([t.split(" ") for t in texts])]

    def decode(self, ids: bytes) -> bytes:
        """The labels of the ids, joined by spaces, in UTF-8."""
        return b" ".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def word_tokenizer(path: str) -> WordTokenizer:
    return per_worker("automaton", path, lambda: WordTokenizer(path))


_IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
_TEXT = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
_DIGEST = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
)


def _source(docs: DataFrame, column: str, kind: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col(column).cast(kind))


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text); null text has no ids. Repeated rows stay repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = word_tokenizer(tokenizer)
        for rows, texts in groups(batches):
            yield batch_of(_IDS, rows.column("doc_id"), own.encode(texts))

    return _source(docs, "text", "string").mapInArrow(tidy(run), "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, text) of every row of ``encoded`` (doc_id, ids); null ids give empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = word_tokenizer(tokenizer)
        for rows in batches:
            for at in range(0, rows.num_rows, 256):
                part = rows.slice(at, 256)
                texts = [own.decode(ids or b"").decode() for ids in part.column("ids").to_pylist()]
                yield batch_of(_TEXT, part.column("doc_id"), texts)

    return _source(encoded, "ids", "binary").mapInArrow(tidy(run), "doc_id long, text string")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Digests of the ids and of the text decoded from them, without moving either out of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = word_tokenizer(tokenizer)
        for rows, texts in groups(batches):
            ids = own.encode(texts)
            yield batch_of(
                _DIGEST,
                rows.column("doc_id"),
                [len(x) // 4 for x in ids],
                [sha256_hex(x) for x in ids],
                [sha256_hex(own.decode(x)) for x in ids],
            )

    return _source(docs, "text", "string").mapInArrow(tidy(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
