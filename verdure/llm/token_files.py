"""Token ids as files of independent zstandard frames with a trailing seek table.

A file holds, in this order: one zstandard frame per document (its ids, little-endian, two bytes each where the
vocabulary allows it, else four), a skippable frame with the directory (document id and number of ids of every
frame) and a skippable frame with the seek table: compressed size, plain size and the low 32 bits of the XXH64 of
the plain bytes for every frame, then the number of frames, a descriptor and a closing magic number. Any
zstandard reader can still unpack the file; ours reads the two tables and then only the frames it was asked for.

Documents without an id sort first. Rows that repeat an id are all kept, in the order of their frames' bytes.
A document is at most 4 GB of ids. Every task writes a file of its own and reports it; files of failed or
repeated attempts are not in the manifest, so losing an executor costs a repeated task and nothing else.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdure.llm.chunks import coder, groups, little_endian
from verdure.llm.common import batch_of, file_system, new_folder
from verdure.llm.memory import tidy
from verdure.session import materialize

# --- fixed values of the zstandard container -----------------------------------------
DIRECTORY_MAGIC = 0x184D2A50
SEEK_TABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
# -------------------------------------------------------------------------------------

NO_ID = -(2**63)
#: UTF-8 bytes of text per file; a parameter of the writer.
FILE_TEXT_BYTES = 32_000_000
LEVEL = 3

_ENTRY = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("check", "<u4")])
_PLACE = np.dtype([("doc", "<i8"), ("ids", "<u4")])
_FRAME_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("plain", pa.int64()), ("check", pa.int64()), ("frame", pa.binary())]
)
_FILE_SCHEMA = pa.schema(
    [("bucket", pa.int32()), ("file", pa.string()), ("first_doc", pa.int64()), ("last_doc", pa.int64())]
    + [("n_docs", pa.int64()), ("n_tokens", pa.int64())]
)
_READ_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary"}
    return ", ".join(f"`{f.name}` {kinds[f.type]}" for f in schema)


def encode_frames(docs: DataFrame, kind: str, tokenizer: str, end_id: int | None, width: int) -> DataFrame:
    """(doc_id, n_tokens, plain, check, frame): every document's ids as one zstandard frame; null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = coder(kind, tokenizer)
        pack = zstandard.ZstdCompressor(level=LEVEL)
        tail = b"" if end_id is None else little_endian([end_id])
        for rows, texts in groups(batches):
            n, plain, check, frames = [], [], [], []
            for ids in encode(texts):
                data = _narrow(ids + tail, width)
                n.append(len(data) // width)
                plain.append(len(data))
                check.append(xxhash.xxh64_intdigest(data) & 0xFFFFFFFF)
                frames.append(pack.compress(data))
            yield batch_of(_FRAME_SCHEMA, rows.column("doc_id"), n, plain, check, frames)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidy(run), _ddl(_FRAME_SCHEMA))


def _narrow(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def write_token_files(
    docs: DataFrame, kind: str, tokenizer: str, end_id: int | None, vocabulary: int, file_text_bytes: int = FILE_TEXT_BYTES
) -> DataFrame:
    """Write ``docs`` (doc_id, text) in ascending doc_id order; returns the manifest, one row per file.

    Files cover ranges of doc_id with about equal numbers of documents, so that together they take
    ``file_text_bytes`` of text each. The ranges come from quantiles of doc_id; frames are encoded before they are
    shuffled, so the shuffle moves packed ids and each text is read once.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    total = docs.agg(F.sum(F.octet_length("text")).alias("b"), F.count("doc_id").alias("n")).first()
    files = max(1, min(total["n"] or 1, -(-(total["b"] or 0) // file_text_bytes)))
    shares = [i / files for i in range(1, files)]
    cuts = docs.select(F.col("doc_id").cast("long")).where("doc_id is not null").approxQuantile("doc_id", shares, 0.1 / files) if shares else []
    width = 2 if vocabulary <= 2**16 else 4
    frames = encode_frames(docs, kind, tokenizer, end_id, width)
    limits = F.array(*[F.lit(int(c)) for c in sorted(set(cuts))]).cast("array<bigint>")
    bucket = F.coalesce(F.size(F.filter(limits, lambda c: c < F.col("doc_id"))), F.lit(0))
    dealt = (
        frames.withColumn("bucket", F.when(F.col("doc_id").isNull(), 0).otherwise(bucket))
        .repartitionById(len(set(cuts)) + 1, F.col("bucket"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "frame")
    )
    folder = new_folder(spark, "tokens")
    manifest = dealt.mapInArrow(tidy(_writer(folder, width)), _ddl(_FILE_SCHEMA))
    return materialize(manifest, "token-files")


def _writer(folder: str, width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        part = TaskContext.get().partitionId()
        name = f"{part:06d}-{uuid.uuid4().hex}.zst"
        entries, places, out = [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                fs.create_dir(base, recursive=True)
                out = fs.open_output_stream(f"{base}/{name}", compression=None)
            frames = batch.column("frame").to_pylist()
            entry, place = np.zeros(len(frames), _ENTRY), np.zeros(len(frames), _PLACE)
            entry["packed"] = [len(f) for f in frames]
            entry["plain"] = batch.column("plain").to_numpy(zero_copy_only=False)
            entry["check"] = batch.column("check").to_numpy(zero_copy_only=False)
            place["doc"] = batch.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
            place["ids"] = batch.column("n_tokens").to_numpy(zero_copy_only=False)
            entries.append(entry)
            places.append(place)
            out.write(b"".join(frames))
        if out is None:
            return
        entry, place = np.concatenate(entries), np.concatenate(places)
        directory = struct.pack("<BI", width, len(place)) + place.tobytes()
        directory += struct.pack("<I", xxhash.xxh64_intdigest(directory) & 0xFFFFFFFF)
        table = entry.tobytes() + struct.pack("<IBI", len(entry), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        out.write(struct.pack("<II", DIRECTORY_MAGIC, len(directory)) + directory)
        out.write(struct.pack("<II", SEEK_TABLE_MAGIC, len(table)) + table)
        out.close()
        first, last = (None if x == NO_ID else int(x) for x in (place["doc"][0], place["doc"][-1]))
        n_tokens = int(place["ids"].sum(dtype=np.int64))
        yield batch_of(_FILE_SCHEMA, [part], [f"{folder}/{name}"], [first], [last], [len(place)], [n_tokens])

    return run


class TokenFile:
    """One file: its tables are read at once, frames only on request."""

    def __init__(self, uri: str):
        fs, path = file_system(uri)
        self.source = fs.open_input_file(path)
        size = self.source.size()
        frames, flags, magic = struct.unpack("<IBI", self.source.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError(f"{uri} has no seek table with checksums")
        table = 9 + frames * _ENTRY.itemsize
        self.entries = np.frombuffer(self.source.read_at(table - 9, size - table), _ENTRY)
        self.at = np.concatenate([[0], np.cumsum(self.entries["packed"], dtype=np.int64)])
        kind, length = struct.unpack("<II", self.source.read_at(8, int(self.at[-1])))
        directory = self.source.read_at(length, int(self.at[-1]) + 8)
        if kind != DIRECTORY_MAGIC or struct.unpack("<I", directory[-4:])[0] != xxhash.xxh64_intdigest(directory[:-4]) & 0xFFFFFFFF:
            raise ValueError(f"the directory of {uri} is damaged")
        self.width = directory[0]
        self.places = np.frombuffer(directory[5:-4], _PLACE)
        self.uri, self.unpack = uri, zstandard.ZstdDecompressor()

    def starts(self) -> np.ndarray:
        """The number of ids in the file before every document."""
        return np.concatenate([[0], np.cumsum(self.places["ids"], dtype=np.int64)])

    def ids(self, i: int) -> bytes:
        """The ids of the i-th document, little-endian unsigned 32-bit."""
        entry = self.entries[i]
        data = self.source.read_at(int(entry["packed"]), int(self.at[i]))
        data = self.unpack.decompress(data, max_output_size=int(entry["plain"])) if entry["plain"] else b""
        if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != entry["check"]:
            raise ValueError(f"document {i} of {self.uri} is damaged")
        return data if self.width == 4 else np.frombuffer(data, "<u2").astype("<u4").tobytes()


def with_offsets(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``, the ids in all earlier files; one row per file is ordered."""
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))


def read_token_files(manifest: DataFrame, wanted: list[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of all documents, or of the ``wanted`` ids.

    With ``wanted``, files outside their range are not opened and other frames not unpacked.
    """
    files = with_offsets(manifest)
    if wanted is not None:
        hit = [F.lit(int(w)).between(F.col("first_doc"), F.col("last_doc")) | (F.col("first_doc").isNull() & (F.lit(int(w)) <= F.col("last_doc"))) for w in wanted]
        files = files.where(F.greatest(*hit, F.lit(False)) if hit else F.lit(False))
    asked = None if wanted is None else np.asarray(sorted(wanted), dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                file = TokenFile(uri)
                starts = file.starts() + start
                picked = np.arange(len(file.places)) if asked is None else np.flatnonzero(np.isin(file.places["doc"], asked))
                for part in np.array_split(picked, max(1, int(file.places["ids"][picked].sum(dtype=np.int64)) // 1_000_000)):
                    docs = [None if d == NO_ID else int(d) for d in file.places["doc"][part]]
                    counts = file.places["ids"][part].astype(np.int64)
                    yield batch_of(_READ_SCHEMA, docs, starts[part], counts, [file.ids(int(i)) for i in part])

    count = max(1, manifest.count())
    return files.select("file", "start").repartition(count, "file").mapInArrow(tidy(run), _ddl(_READ_SCHEMA))


def digests(read: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of what was read."""
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def crc32_of(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF
