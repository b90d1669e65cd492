"""Pre-tokenization of plain Latin text by array operations.

A group of texts is one byte array. Classes of neighbouring bytes give the starts of all pre-tokens, each token gets a
64-bit hash of its bytes and every different token of the group is looked up, or encoded, once; the ids of the texts are
then gathered from the few different answers. Follows the splitting rules of byte-level vocabularies (a token takes the
one space before it) and of lower-cased word vocabularies (white space dropped, digits alone). Texts with anything but
ASCII and Latin letters up to U+024F, or with the start of a special token, are left to the general way.
"""

from __future__ import annotations

import secrets
from collections.abc import Callable

import numpy as np

from verdure.llm.memory import Memory

#: Bytes handled at once, and the longest token that is hashed.
GROUP_BYTES = 1_000_000
LONGEST_HASHED = 64

LETTER, DIGIT, OTHER, WHITE, BREAK, FOREIGN = range(6)
_BREAK = b"\0"


def _classes() -> np.ndarray:
    table = np.full(256, FOREIGN, np.uint8)
    table[0x21:0x7F] = OTHER
    for b in range(0x21, 0x7F):
        if chr(b).isalpha():
            table[b] = LETTER
        elif chr(b).isdigit():
            table[b] = DIGIT
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = WHITE
    # two-byte letters: U+00C0 to U+024F
    table[0xC3:0xCA] = LETTER
    table[0x80:0xC0] = LETTER
    return table


_CLASS = _classes()
#: An odd multiplier drawn anew by every process.
_FACTOR = secrets.randbits(64) | 1


def _powers(base: int) -> np.ndarray:
    return np.cumprod(np.full(GROUP_BYTES + 64, base % 2**64, np.uint64))



#: Fixed endings after an apostrophe that make a token with it.
_SHORT = np.isin(np.arange(256), np.frombuffer(b"stmd", np.uint8))
_LONG = (b"re", b"ve", b"ll")


def is_plain(data: bytes) -> bool:
    """Whether all of a text's bytes are in the classes above; checked before anything is hashed."""
    if b"<|" in data or b"\0" in data:
        return False
    if data.isascii():
        return not (_CLASS[np.frombuffer(data, np.uint8)] == FOREIGN).any()
    x = np.frombuffer(data, np.uint8)
    if (_CLASS[x] == FOREIGN).any():
        return False
    lead = np.flatnonzero(x >= 0xC3)
    second = x[lead + 1]
    signs = (x[lead] == 0xC3) & ((second == 0x97) | (second == 0xB7))
    return not (signs | ((x[lead] == 0xC9) & (second > 0x8F))).any() and len(lead) == int(((x >= 0x80) & (x < 0xC0)).sum())


def token_starts(x: np.ndarray, spaced: bool) -> np.ndarray:
    """Starts of the pieces of ``x``, white space and breaks among them."""
    kind = _CLASS[x]
    kind[x == 0] = BREAK
    start = np.ones(len(x), bool)
    start[1:] = kind[1:] != kind[:-1]
    if spaced:
        # white space before a visible byte: its last byte stands alone or, if a space, goes with what follows
        after = np.flatnonzero((kind[:-1] == WHITE) & (kind[1:] <= OTHER)) + 1
        start[after - 1] = True
        start[after[x[after - 1] == 0x20]] = False
    else:
        start |= kind == DIGIT
    quote = np.flatnonzero(x[:-1] == 0x27)
    if len(quote):
        padded = np.concatenate([x, np.zeros(3, np.uint8)])
        # the apostrophe begins its run, with no space taken along, and letters follow
        run = start[quote] & (kind[quote + 1] == LETTER)
        quote = quote[run]
        one, two = padded[quote + 1], padded[quote + 2]
        length = np.where(_SHORT[one], 1, 0)
        for pair in _LONG:
            length[(one == pair[0]) & (two == pair[1])] = 2
        quote, length = quote[length > 0], length[length > 0]
        start[quote + 1] = False
        end = quote + 1 + length
        start[end[end < len(x)]] = True
    return np.flatnonzero(start)


class PlainCoder:
    """Ids of plain texts; ``encode`` maps different tokens to their ids (little-endian unsigned 32-bit)."""

    def __init__(self, spaced: bool, lower: bool, encode: Callable[[list[bytes]], list[bytes]]):
        self.spaced, self.lower, self.memory = spaced, lower, Memory(encode)
        self.powers, self.inverses = _powers(_FACTOR), _powers(pow(_FACTOR, -1, 2**64))

    def __call__(self, texts: list[str]) -> list[bytes | None]:
        """The ids of each text; None for texts that are not plain."""
        done: list[bytes | None] = [None] * len(texts)
        group: list[tuple[int, bytes]] = []
        size = 0
        for i, text in enumerate(texts):
            data = (text.lower() if self.lower else text).encode("utf-8", "surrogatepass")
            if len(data) > GROUP_BYTES or not is_plain(data):
                continue
            if size + len(data) > GROUP_BYTES:
                self._encode(group, done)
                group, size = [], 0
            group.append((i, data))
            size += len(data) + 1
        if group:
            self._encode(group, done)
        return done

    def _encode(self, group: list[tuple[int, bytes]], done: list[bytes | None]) -> None:
        data = _BREAK.join(d for _, d in group) + _BREAK
        x = np.frombuffer(data, np.uint8)
        start = token_starts(x, self.spaced)
        end = np.append(start[1:], len(x))
        kind = _CLASS[x[start]]
        wanted = x[start] != 0 if self.spaced else (x[start] != 0) & (kind != WHITE)
        start, end = start[wanted], end[wanted]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((x.astype(np.uint64) + np.uint64(1)) * self.powers[: len(x)])])
        key = (sums[end] - sums[start]) * self.inverses[start] ^ ((end - start).astype(np.uint64) << np.uint64(48))
        long = np.flatnonzero(end - start > LONGEST_HASHED)
        # long tokens are not trusted to the hash: each is looked up on its own
        key[long] = np.arange(len(long), dtype=np.uint64) | np.uint64(0xFFFF << 48)
        _, first, number = np.unique(key, return_index=True, return_inverse=True)
        tokens = [data[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
        values = self.memory.values([tokens])[0]
        pool = np.frombuffer(b"".join(values), "<u4")
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
        offset = np.cumsum(sizes) - sizes
        counts = sizes[number]
        upto = np.concatenate([[0], np.cumsum(counts)])
        ids = pool[np.repeat(offset[number] - upto[:-1], counts) + np.arange(upto[-1])]
        ends = np.cumsum([len(d) + 1 for _, d in group])
        cut = upto[np.searchsorted(start, ends)]
        raw, at = ids.tobytes(), 0
        for (i, _), c in zip(group, cut.tolist(), strict=True):
            done[i] = raw[4 * at : 4 * c]
            at = c
