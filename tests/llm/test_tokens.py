"""Token ids, token files and packing against the library and brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from verdure.llm import automaton, packing, token_files
from verdure.llm.chunks import coder, load_tokenizer
from verdure.llm.common import sha256_hex
from verdure.llm.plain import PlainCoder, is_plain

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
LETTERS = [
    "a", "B", " ", "  ", "\n", "\t", "'s", "'ll", "'re", "'", "''", "1", "22", "é", "É", "ß", "ā", "ɏ", "!", "?!", "ing", "The", " the", "<", "|",
    "×", "÷", "ɐ", "́", "Σ", "İ", "<|endoftext|>", "<|startoftext|>", "\x1c", "\x00", " ", "　", "日本", "😀", "ǅ", "½",
]


def little(ids):
    return np.asarray(ids, "<u4").tobytes()


def library(path, texts, end=None):
    tokenizer = load_tokenizer(path)
    ids = [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    return [x + ([end] if end is not None else []) for x in ids]


def mixed(seed, count=4000):
    rng = random.Random(seed)
    return ["".join(rng.choices(LETTERS[: rng.choice([25, len(LETTERS)])], k=rng.randint(0, 25))) for _ in range(count)]


@pytest.mark.parametrize("kind, path", [("word", WORD), ("byte", BYTE)])
def test_ids_equal_the_library(kind, path, odd_texts):
    texts = [t or "" for t in odd_texts] + mixed(1)
    assert coder(kind, path)(texts) == [little(x) for x in library(path, texts)]


def test_plain_texts_are_recognised():
    assert is_plain("Plain été ā, 1!".encode()) and not is_plain("3 × 4".encode()) and not is_plain("日".encode())
    assert PlainCoder(True, False, lambda w: [b"" for _ in w])(["a <|b"]) == [None]


def test_automaton_equals_the_library(odd_texts):
    texts = [t or "" for t in odd_texts] + mixed(2)
    own = automaton.word_tokenizer(WORD)
    tokenizer = load_tokenizer(WORD)
    ids = library(WORD, texts)
    assert own.encode(texts) == [little(x) for x in ids]
    assert [own.decode(little(x)).decode() for x in ids] == [tokenizer.decode(x, skip_special_tokens=False) for x in ids]


def test_gadgets_on_a_small_vocabulary():
    """Against merging by rank, for all words over two letters up to length nine."""
    symbols = automaton.byte_symbols()
    merges = [("a", "a"), ("a", "b"), ("aa", "a"), ("ab", "ab"), ("b", "a"), ("aa", "ab")]
    vocabulary = {s: i for i, s in enumerate([*symbols, *(x + y for x, y in merges)])}
    rank = {m: i for i, m in enumerate(merges)}
    machine = automaton.Automaton(vocabulary, merges)

    def by_rank(word):
        parts = list(word)
        while True:
            pairs = [(rank[p], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in rank]
            if not pairs:
                return [vocabulary[p] for p in parts]
            best = min(pairs)[0]
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and rank.get((parts[i], parts[i + 1])) == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out

    for n in range(1, 10):
        for bits in range(2**n):
            word = "".join("ab"[bits >> k & 1] for k in range(n))
            assert machine.encode(word.encode()) == by_rank(word), word


def test_two_rules_for_a_token_are_refused():
    symbols = automaton.byte_symbols()
    vocabulary = {s: i for i, s in enumerate([*symbols, "ab", "bc", "abc"])}
    with pytest.raises(ValueError, match="two rules"):
        automaton.Automaton(vocabulary, [("a", "b"), ("b", "c"), ("ab", "c"), ("a", "bc")])


def test_round_trip_of_documents(make_docs, odd_texts):
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(3, "twice"), (None, "no id")]
    docs = make_docs(rows, clashing=True)
    tokenizer, ids = load_tokenizer(WORD), library(WORD, [t for _, t in rows])
    want = sorted(
        (str(i), len(x), sha256_hex(little(x)), sha256_hex(tokenizer.decode(x, skip_special_tokens=False).encode()))
        for (i, _), x in zip(rows, ids, strict=True)
    )
    got = automaton.round_trip(docs, WORD).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    encoded = automaton.encode_documents(docs, WORD)
    texts = sorted(r.text for r in automaton.decode_documents(encoded, WORD).collect())
    assert texts == sorted(tokenizer.decode(x, skip_special_tokens=False) for x in ids)
    assert automaton.round_trip(docs.limit(0), WORD).count() == 0


@pytest.mark.parametrize("size", [1_000, 10**9])
def test_token_files(make_docs, odd_texts, size):
    rows = [(2 * i, t) for i, t in enumerate(odd_texts)] + [(4, "twice"), (None, "no id")]
    rows = [(i, t) for i, t in rows if t is None or len(t) < 10_000 or size > 1_000]
    manifest = token_files.write_token_files(make_docs(rows, clashing=True), "byte", BYTE, 0, 50_257, size)
    assert (manifest.count() > 1) == (size == 1_000)
    got = token_files.digests(token_files.read_token_files(manifest)).collect()
    ids = library(BYTE, [t for _, t in rows], 0)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (str(i), len(x), zlib.crc32(little(x))) for (i, _), x in zip(rows, ids, strict=True)
    )
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted((i for i, _ in rows), key=lambda i: -1 if i is None else i)
    assert [r.start for r in ordered] == [sum(x.n_tokens for x in ordered[:k]) for k in range(len(ordered))]
    some = token_files.read_token_files(manifest, [6, 8, 10**6]).collect()
    assert sorted(r.doc_id for r in some) == [6, 8]
    assert {(r.doc_id, r.start) for r in some} <= {(r.doc_id, r.start) for r in got}
    assert token_files.read_token_files(manifest, []).count() == 0


def test_token_files_of_nothing(make_docs):
    manifest = token_files.write_token_files(make_docs([(1, "x")]).limit(0), "byte", BYTE, 0, 50_257)
    assert manifest.count() == 0 and token_files.read_token_files(manifest).count() == 0


def test_damage_is_noticed_and_only_asked_frames_are_read(make_docs):
    docs = make_docs([(i, f"document number {i} " * 50) for i in range(20)])
    manifest = token_files.write_token_files(docs, "byte", BYTE, 0, 50_257, 10**9)
    uri = manifest.first()["file"]
    path = uri.removeprefix("file://")
    with open(path, "r+b") as f:
        data = bytearray(f.read())
        first = token_files.TokenFile(uri)
        spot = int(first.at[3]) + int(first.entries[3]["packed"]) // 2
        data[spot] ^= 0xFF
        f.seek(0)
        f.write(data)
    damaged = token_files.TokenFile(uri)
    assert damaged.ids(2) == first.ids(2)
    with pytest.raises(Exception, match="damaged|Decompress|decompress"):
        damaged.ids(3)
    assert token_files.read_token_files(manifest, [2]).count() == 1
    import zstandard

    # any zstandard reader unpacks the file as a whole up to the damage
    with open(path, "rb") as f:
        plain = zstandard.ZstdDecompressor().stream_reader(f).read(int(first.entries[0]["plain"]))
    assert np.frombuffer(plain, "<u2").astype("<u4").tobytes() == first.ids(0)


def check_pieces(rows, got, end, length=packing.LENGTH):
    ids = {}
    for (i, _), x in zip(rows, library(WORD, [t for _, t in rows], end), strict=True):
        ids.setdefault(i, []).append(x)
    pieces, sequences = {}, {}
    for r in got:
        assert any(zlib.crc32(little(x[r.start : r.start + r.length])) == r.ids_crc32 and len(x) == r.doc_tokens for x in ids[r.doc_id])
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert {i: sum(n for _, n in p) for i, p in pieces.items()} == {i: sum(map(len, x)) for i, x in ids.items()}
    for p in sequences.values():
        ends = [0]
        for at, n in sorted(p):
            assert at == ends[-1] and n > 0
            ends.append(at + n)
        assert ends[-1] <= length
    lengths = [sum(n for _, n in p) for p in sequences.values()]
    return lengths


def source_rows(seed, count=400):
    rng = random.Random(seed)
    names = ["hot"] * 6 + ["a", "b", None]
    return [(i, " ".join(rng.choices(["word", "other", "thing", "über"], k=rng.randint(0, 400))), "en", rng.choice(names), 1) for i in range(count)]


def test_packing_holds_every_token_once(make_docs, odd_texts):
    rows = source_rows(3) + [(1000 + i, t, "en", "odd", 0) for i, t in enumerate(odd_texts)] + [(1, "same id", "en", "a", 1)]
    got = packing.pack(make_docs(rows, clashing=True), "word", WORD, 1, segment_windows=1).collect()
    lengths = check_pieces([r[:2] for r in rows], got, 1)
    # no sequence is padded: full ones and powers of two
    assert all(packing.pad_to(n) == n for n in lengths)
    assert sum(n == packing.LENGTH for n in lengths) >= sum(lengths) // packing.LENGTH - 1


def test_windows_hold_the_target_proportions(make_docs):
    rows = source_rows(4, 800)
    pieces = packing.pack(make_docs(rows), "word", WORD, 1, window=4, segment_windows=3)
    pieces = pieces.groupBy("window", "queue").agg(F.sum("length").alias("n")).collect()
    total, by_window = {}, {}
    for r in pieces:
        total[r.queue] = total.get(r.queue, 0) + r.n
        by_window.setdefault(r.window, {})[r.queue] = r.n
    everything = sum(total.values())
    full = [w for w in by_window.values() if sum(w.values()) == 4 * packing.LENGTH]
    assert len(full) >= 3
    for w in full:
        for q, n in total.items():
            assert abs(w.get(q, 0) - n / everything * 4 * packing.LENGTH) <= len(total) + 1


def test_weights_and_empty_tables(make_docs):
    rows = source_rows(5, 300)
    weights = {"=hot": 0.2, "=a": 0.4, "=b": 0.4}
    got = packing.pack(make_docs(rows), "word", WORD, 1, weights, segment_windows=1).collect()
    check_pieces([r[:2] for r in rows], got, 1)
    assert packing.pack(make_docs(rows).limit(0), "word", WORD, 1).count() == 0
    assert packing.pack(make_docs([(1, None)]), "word", WORD, 1).collect()[0].length == 1


def test_deficits_carry():
    counts, capacity = np.asarray([1000, 333, 7, 0]), 100
    given = list(packing.windows_of(counts, np.zeros(4), capacity))
    assert (sum(given) == counts).all() and all(x.sum() == capacity for x in given[:-1])
    running = np.cumsum(given, axis=0)
    for k, x in enumerate(running[:-1]):
        assert (np.abs(x - (k + 1) * capacity * counts / counts.sum()) <= 2).all()


def test_schedule_cuts_are_consistent():
    plan = packing.Schedule.of({"a": 12_345, "b": 1, "c": 777_777}, {"a": 3, "b": 1, "c": 2}, 10_000)
    for q, total in enumerate(plan.totals):
        at = np.arange(0, total, max(1, total // 997))
        segment = plan.segments_of(q, at)
        assert (plan.first(q, segment) <= at).all() and (at < plan.first(q, segment + 1)).all()
