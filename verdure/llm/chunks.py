"""Token ids of whole texts by the tokenizers library, each different piece encoded once.

Plain Latin texts are split into pre-tokens by array operations and the library's merge model encodes the different
ones. Any other text is cut before single spaces, where both tokenizer families start a new pre-token, and the
library's whole chain encodes the different chunks. Answers are kept in bounded memories of the worker.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa

from verdure.llm.memory import Memory, per_worker
from verdure.llm.plain import PlainCoder

#: Characters of text worked on together, and rows by which a group grows.
GROUP_CHARS = 2_000_000
SLICE_ROWS = 64


def load_tokenizer(path: str):
    """The library's tokenizer without truncation and padding, one thread in every worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def little_endian(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)}
    rest = {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - plain))}
    return [rest.get(b, chr(b)) for b in range(256)]


def _chain(tokenizer, before: str = "") -> Callable[[list[str]], list[bytes]]:
    """The library's whole chain for chunks; ``before`` is put in front of each."""

    def encode(chunks: list[str]) -> list[bytes]:
        done: list[bytes] = []
        for at in range(0, len(chunks), 20_000):
            texts = [before + c for c in chunks[at : at + 20_000]]
            done += [little_endian(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return done

    return encode


def _merges(tokenizer) -> Callable[[list[bytes]], list[bytes]]:
    """The library's merge model alone, for pre-tokens."""
    symbols = dict(enumerate(byte_symbols()))
    merge = tokenizer.model.tokenize
    return lambda tokens: [little_endian([t.id for t in merge(w.decode("latin-1").translate(symbols))]) for w in tokens]


class GeneralCoder:
    """Ids of texts of any kind.

    Under a word vocabulary a chunk is what lies between spaces. Under a byte-level one it takes the space before it:
    where each chunk starts with a visible character the cut at every space is safe, other texts are cut only before a
    space that a visible ASCII character follows.
    """

    _BREAK = re.compile(r"(?= [!-~])")

    def __init__(self, tokenizer, spaced: bool):
        self.spaced = spaced
        self.heads = Memory(_chain(tokenizer))
        self.tails = Memory(_chain(tokenizer, " "))

    def __call__(self, texts: list[str]) -> list[bytes]:
        cut = [t.split(" ") for t in texts]
        if not self.spaced:
            return [b"".join(ids) for ids in self.heads.values(cut)]
        odd = [any(not c or c[0].isspace() for c in chunks[1:]) for chunks in cut]
        heads = self.heads.values([self._BREAK.split(t) if o else c[:1] for t, c, o in zip(texts, cut, odd, strict=True)])
        tails = self.tails.values([[] if o else c[1:] for c, o in zip(cut, odd, strict=True)])
        return [b"".join(h) + b"".join(t) for h, t in zip(heads, tails, strict=True)]


class Coder:
    """Ids of whole texts, little-endian unsigned 32-bit."""

    def __init__(self, plain: PlainCoder, general: Callable[[list[str]], list[bytes]]):
        self.plain, self.general = plain, general

    def __call__(self, texts: list[str]) -> list[bytes]:
        done = self.plain(texts)
        rest = [i for i, ids in enumerate(done) if ids is None]
        for i, ids in zip(rest, self.general([texts[i] for i in rest]), strict=True):
            done[i] = ids
        return done


def coder(kind: str, path: str) -> Coder:
    """The worker's coder of a tokenizer file; ``kind`` is ``word`` or ``byte``."""

    def make() -> Coder:
        tokenizer, spaced = load_tokenizer(path), kind == "byte"
        return Coder(PlainCoder(spaced, not spaced, _merges(tokenizer)), GeneralCoder(tokenizer, spaced))

    return per_worker(kind, path, make)


def groups(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a bounded number of characters with their texts; null counts as empty."""
    for batch in batches:
        at, texts, chars = 0, [], 0
        for start in range(0, batch.num_rows, SLICE_ROWS):
            for t in batch.column(text).slice(start, SLICE_ROWS).to_pylist():
                texts.append(t or "")
                chars += len(texts[-1])
            if chars >= GROUP_CHARS:
                yield batch.slice(at, len(texts)), texts
                at, texts, chars = at + len(texts), [], 0
        if texts:
            yield batch.slice(at), texts
