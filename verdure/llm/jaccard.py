"""Exact join of documents on the Jaccard similarity of their word shingles, and its components.

Two documents link when ``100 * shared >= 75 * union`` of their shingle sets. Documents with equal sets are one class
and every step below works on classes.

1. *Index.* Tasks hash the shingles of whole texts and send them, packed by bucket, to the task that owns the bucket.
   It counts the classes of every token and passes on the tokens that at least two classes have; the others cannot
   be shared. Only classes with enough of those can have a partner, and nearly all others end here.
2. *Lists.* Tokens are ordered by (classes that have it, token), the same for everyone. Linked classes share a token
   among the first ``size - least overlap + 1`` of each; those, minus the unshared ones that come first in this order,
   are put into inverted lists with size and position.
3. *Computed answers.* In each list all others are compared with its leader and the overlaps are kept. Whoever links
   with a leader needs no comparison inside the leader's component any more. Lists that still hold several components
   get a new leader out of their largest one, which is compared with the members of the others only, again and again as
   long as that merges components and has more than a few pairs to ask: in a group of near copies the rest shrinks by a
   share each time, so the pairs stay in proportion to the group.
4. *Derived answers.* What remains are pairs from different components that no leader could merge. Lists are cut into blocks by size and only
   neighbouring blocks meet; a pair is skipped when its positions, its overlaps with the leader (``y`` and ``z`` share
   at most ``min(xy, xz) + min(size y - xy, size z - xz)``) or the parity bits of the sets bound the overlap below what
   a link needs. The rest is compared, each pair once.

No pair that can link is skipped. Sets are kept as 64-bit hashes, classes by a 64-bit digest of their set.
A document without words links with nothing.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdure.llm.chunks import groups
from verdure.llm.common import fresh, quoted
from verdure.llm.memory import forget, tidy
from verdure.operators.components import connected_components
from verdure.session import materialize, settled

WORDS = 5
#: UTF-8 bytes of text whose tokens make one bucket, and the range of bucket numbers.
BUCKET_BYTES = 32_000_000
LEAST_BUCKETS, MOST_BUCKETS = 24, 32_000
PARITY_WORDS = 8
#: Lists of a class up to which each entry carries the tokens before it; more only cost repeated pairs.
MOST_BEFORE = 256
#: Rounds of new leaders; lists that still merge after as many go to the derived comparison. Changes no result.
MOST_ROUNDS = 16
#: Pairs of a round of new leaders up to which another one could settle hardly any more; neither does this change a result.
FEW_PAIRS = 100

# odd multipliers of the hash; any would do
_MULTIPLIERS = [np.uint64(2 * xxhash.xxh64_intdigest(str(i)) % 2**64 | 1) for i in range(WORDS)]

_OUT = pa.schema(
    [("bucket", pa.int32()), ("blob", pa.binary()), ("doc_id", pa.int64()), ("cls", pa.int64()), ("n", pa.int64()), ("bits", pa.list_(pa.int64()))]
)
_OUT_DDL = "bucket int, blob binary, doc_id long, cls long, n long, bits array<long>"
_COUNTED = pa.schema(
    [("is_doc", pa.bool_()), ("doc_id", pa.int64()), ("cls", pa.int64()), ("n", pa.int64())]
    + [("bits", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64())), ("df", pa.list_(pa.int32()))]
)
_COUNTED_DDL = "is_doc boolean, doc_id long, cls long, n long, bits array<long>, tokens array<long>, df array<int>"


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MULTIPLIERS[0]
    return h ^ (h >> np.uint64(29))


def shingle_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts one after the other, and the limits of each text's share."""
    words, counts = [], []
    for t in texts:
        own = t.encode("utf-8", "replace").lower().split()
        counts.append(len(own))
        words += own
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    count = np.asarray(counts, dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(count)])
    h = np.zeros(len(w), np.uint64)
    for j in range(WORDS):
        # a window that would leave its text is not taken up below, save that of a short text: all its words
        shifted = np.zeros(len(w), np.uint64)
        shifted[: max(0, len(w) - j)] = w[j:]
        if j:
            size = np.repeat(count, count)
            at = np.arange(len(w)) - np.repeat(first[:-1], count)
            shifted[(size < WORDS) & (at + j >= size)] = 0
        h = _mixed(h ^ (shifted * _MULTIPLIERS[j]))
    windows = np.where(count >= WORDS, count - WORDS + 1, np.minimum(count, 1))
    limits = np.concatenate([[0], np.cumsum(windows)])
    taken = np.empty(limits[-1], np.uint64)
    for a, b, f in zip(limits[:-1].tolist(), limits[1:].tolist(), first[:-1].tolist(), strict=True):
        if b > a:
            part = h[f : f + b - a]
            part.sort()
            taken[a:b] = part
    new = np.ones(len(taken), bool)
    new[1:] = taken[1:] != taken[:-1]
    new[limits[:-1][windows > 0]] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    return taken[new], kept[limits]


def _per_set(ufunc: np.ufunc, values: np.ndarray, limits: np.ndarray) -> np.ndarray:
    sizes = np.diff(limits)
    out = np.zeros(len(sizes), np.uint64)
    some = sizes > 0
    if some.any():
        out[some] = ufunc.reduceat(values, limits[:-1][some])
    return out


def class_ids(h: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """A digest of every set; sets are in sorted order, so the place of a hash may count."""
    place = np.arange(len(h), dtype=np.uint64) - np.repeat(limits[:-1], np.diff(limits)).astype(np.uint64)
    total = _per_set(np.add, _mixed(h ^ (place * _MULTIPLIERS[1])), limits)
    mixed = _per_set(np.bitwise_xor, _mixed(h * _MULTIPLIERS[2]), limits)
    return _mixed(total ^ _mixed(mixed ^ np.diff(limits).astype(np.uint64))).view(np.int64)


def parity_bits(h: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """``PARITY_WORDS`` x 64 bits per set: the parity of the number of its hashes in each of as many bins."""
    word = (h >> np.uint64(20)) & np.uint64(PARITY_WORDS - 1)
    bit = np.uint64(1) << ((h >> np.uint64(23)) & np.uint64(63))
    columns = [_per_set(np.bitwise_xor, np.where(word == np.uint64(w), bit, np.uint64(0)), limits) for w in range(PARITY_WORDS)]
    return np.stack(columns, axis=1).view(np.int64)


def _send(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        sent: set[int] = set()
        for rows, texts in groups(batches):
            h, limits = shingle_hashes(texts)
            cls, n = class_ids(h, limits), np.diff(limits)
            none = pa.nulls(len(texts), pa.binary())
            bits = parity_bits(h, limits)
            places = ((cls.view(np.uint64) >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(places), none, rows.column("doc_id"), pa.array(cls), pa.array(n), pa.array(list(bits), type=pa.list_(pa.int64()))],
                schema=_OUT,
            )
            # of equal sets in a task one goes on
            new = np.zeros(len(texts), bool)
            for i, c in enumerate(cls.tolist()):
                if n[i] and c not in sent:
                    sent.add(c)
                    new[i] = True
            owner = np.repeat(np.arange(len(texts)), n)
            taken = new[owner]
            h, owner = h[taken], owner[taken]
            bucket = (((h >> np.uint64(48)) * np.uint64(buckets)) >> np.uint64(16)).astype(np.uint16)
            order = np.argsort(bucket, kind="stable")
            h, owner, bucket = h[order], owner[order], bucket[order]
            edges = np.searchsorted(bucket, np.arange(buckets + 1))
            blobs, numbers = [], []
            for b in range(buckets):
                part = slice(edges[b], edges[b + 1])
                if edges[b + 1] > edges[b]:
                    own, m = np.unique(owner[part], return_counts=True)
                    low = (h[part] & np.uint64(0xFFFFFFFF)).astype("<u4")
                    high = ((h[part] >> np.uint64(32)) & np.uint64(0xFFFF)).astype("<u2")
                    head = [struct.pack("<I", len(own)), cls[own].astype("<i8"), n[own].astype("<u4"), m.astype("<u4"), low, high]
                    blobs.append(b"".join(x if isinstance(x, bytes) else x.tobytes() for x in head))
                    numbers.append(b)
            if blobs:
                empty = pa.nulls(len(blobs), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers, pa.int32()), pa.array(blobs, pa.binary()), empty, empty, empty, pa.nulls(len(blobs), pa.list_(pa.int64()))],
                    schema=_OUT,
                )

    return run


def _gathered(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Classes and sizes of all blobs, tokens and the number of each token's class; empties ``blobs``."""
    heads = []
    for b in blobs:
        k = struct.unpack_from("<I", b)[0]
        heads.append((np.frombuffer(b, "<i8", k, 4), np.frombuffer(b, "<u4", k, 4 + 8 * k), np.frombuffer(b, "<u4", k, 4 + 12 * k)))
    cls, n, counts = (np.concatenate([h[i] for h in heads]).astype(np.int64) for i in range(3))
    token = np.empty(int(counts.sum()), np.int64)
    owner = np.repeat(np.arange(len(cls), dtype=np.int32), counts)
    sizes = [(len(h[0]), int(h[2].sum(dtype=np.int64))) for h in heads]
    del heads
    end = len(token)
    while blobs:
        k, total = sizes.pop()
        low = np.frombuffer(blobs[-1], "<u4", total, 4 + 16 * k)
        high = np.frombuffer(blobs[-1], "<u2", total, 4 + 16 * k + 4 * total)
        token[end - total : end] = high
        token[end - total : end] <<= 32
        token[end - total : end] |= low
        end -= total
        del low, high
        blobs.pop()
    return cls, n, token, owner


def shared_tokens(bucket: int, blobs: list[bytes]) -> pa.RecordBatch | None:
    """Per class of a bucket: its tokens that other classes have too, and how many classes have each."""
    cls, n, token, owner = _gathered(blobs)
    ordered = np.sort(token)
    repeated = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    del ordered
    several = np.zeros(len(token), bool)
    for at in range(0, len(token) if len(repeated) else 0, 500_000):
        part = token[at : at + 500_000]
        several[at : at + 500_000] = repeated[np.minimum(np.searchsorted(repeated, part), len(repeated) - 1)] == part
    token, owner = token[several], owner[several]
    ids, number = np.unique(cls, return_inverse=True)
    size = np.zeros(len(ids), np.int64)
    size[number] = n
    owner = number[owner]
    # the same class may come from several tasks
    order = np.lexsort((owner, token))
    token, owner = token[order], owner[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
    token, owner = token[new], owner[new]
    if not len(token):
        return None
    starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    df = np.repeat(np.diff(np.concatenate([starts, [len(token)]])), np.diff(np.concatenate([starts, [len(token)]])))
    token, owner, df = token[df >= 2], owner[df >= 2], df[df >= 2]
    if not len(token):
        return None
    order = np.argsort(owner, kind="stable")
    token, owner, df = token[order] + (bucket << 48), owner[order], df[order]
    which, first = np.unique(owner, return_index=True)
    offsets = pa.array(np.concatenate([first, [len(owner)]]).astype(np.int32))
    k = len(which)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([False] * k),
            pa.nulls(k, pa.int64()),
            pa.array(ids[which]),
            pa.array(size[which]),
            pa.nulls(k, pa.list_(pa.int64())),
            pa.ListArray.from_arrays(offsets, pa.array(token)),
            pa.ListArray.from_arrays(offsets, pa.array(df.astype(np.int32))),
        ],
        schema=_COUNTED,
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partition is one bucket; what is not a bucket's blob passes through."""
    blobs: dict[int, list[bytes]] = {}
    for batch in batches:
        held = np.asarray(batch.column("blob").is_valid())
        for bucket, blob, has in zip(batch.column("bucket").to_pylist(), batch.column("blob"), held, strict=True):
            if has:
                blobs.setdefault(bucket, []).append(blob.as_py())
        docs = batch.filter(pa.array(~held))
        if docs.num_rows:
            k = docs.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([True] * k), *(docs.column(c) for c in ("doc_id", "cls", "n", "bits"))]
                + [pa.nulls(k, pa.list_(pa.int64())), pa.nulls(k, pa.list_(pa.int32()))],
                schema=_COUNTED,
            )
    for bucket, parts in blobs.items():
        found = shared_tokens(bucket, parts)
        if found is not None:
            yield found


def _index(docs: DataFrame) -> DataFrame:
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = int(min(MOST_BUCKETS, max(LEAST_BUCKETS, size // BUCKET_BYTES)))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sent = rows.mapInArrow(tidy(_send(buckets)), _OUT_DDL)
    return materialize(sent.repartitionById(buckets, F.col("bucket")).mapInArrow(tidy(_count), _COUNTED_DDL), "shingles")


def _links(overlap: str, a: str, b: str) -> str:
    """100 * overlap >= 75 * union of sets of sizes ``a`` and ``b``."""
    return f"7 * ({overlap}) >= 3 * ({a} + {b})"


def _sets(index: DataFrame) -> DataFrame:
    """Classes that may have a partner: cls, n, shared (number of shared tokens), tokens, prefix, bits."""
    rows = index.where("not is_doc")
    able = rows.groupBy("cls").agg(F.sum(F.size("tokens")).alias("shared"), F.first("n").alias("n")).where("4 * shared >= 3 * n")
    pieces = rows.select("cls", "tokens", "df").join(able.select("cls", "n", "shared"), "cls", "left_semi")
    gathered = pieces.groupBy("cls").agg(
        F.array_sort(F.flatten(F.collect_list(F.arrays_zip(F.col("df"), F.col("tokens").alias("token"))))).alias("x")
    )
    bits = index.where("is_doc").groupBy("cls").agg(F.first("bits").alias("bits"))
    length = F.expr("greatest(0, cast(n - (3 * n + 3) div 4 + 1 - (n - shared) as int))")
    return materialize(
        gathered.join(able, "cls").join(bits, "cls").select(
            "cls", "n", "shared", "bits", F.col("x.token").alias("tokens"), F.slice(F.col("x.token"), F.lit(1), length).alias("prefix")
        ),
        "shingle-sets",
    )


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, overlap, linked) of pairs (a, b) of classes."""
    one = sets.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    two = sets.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = pairs.join(one, "a").join(two, "b")
    sized = both.select("a", "b", "na", "nb", F.size(F.array_intersect("ta", "tb")).cast("long").alias("overlap"))
    return sized.select("a", "b", "overlap", F.expr(_links("overlap", "na", "nb")).alias("linked"))


_SIZES = "4 * least({0}, {1}) >= 3 * greatest({0}, {1})"
_PLACES = "least(pos, pos2) + least(shared - pos, shared2 - pos2)"


def _numbered(entries: DataFrame) -> DataFrame:
    """Entries with their size block and the tokens ``before`` them in their class's entries.

    Two classes are compared in the first list that has both, the one before which they have no token in common.
    Classes in more than ``MOST_BEFORE`` of these lists go without: their pairs come up in several lists and are
    made distinct afterwards.
    """
    row = F.struct("pos", "token", "overlap")
    block = F.floor(F.log("n") / F.log(F.lit(4 / 3))).cast("int").alias("block")
    one = [F.first(c).alias(c) for c in ("n", "shared", "bits", "component")]
    own = entries.groupBy("cls").agg(*one, F.array_sort(F.collect_list(row)).alias("e"))
    each = own.select("cls", "n", "shared", "bits", "component", block, F.col("e.token").alias("tokens"), F.posexplode("e").alias("k", "x"))
    before = F.when(F.size("tokens") <= MOST_BEFORE, F.slice("tokens", F.lit(1), F.col("k")))
    return materialize(each.select("cls", "n", "shared", "bits", "component", "block", before.alias("before"), "x.*"), "shingle-left")


def _parity(a: str, b: str) -> str:
    """Least size of the difference of two sets, from the parity bits."""
    return "(" + " + ".join(f"bit_count({a}[{i}] ^ {b}[{i}])" for i in range(PARITY_WORDS)) + ")"


def _mixed_only(entries: DataFrame) -> DataFrame:
    """Entries of the lists that hold several components."""
    mixed = entries.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    return entries.join(mixed.select("token"), "token", "left_semi")


def _next_leaders(pool: DataFrame, round_no: int) -> DataFrame:
    """Pairs (a, b, ca, cb): a member of the largest component of every live list, and the members of its others that may link with it."""
    member = F.struct(F.xxhash64(F.lit(round_no), "cls").alias("h"), "cls", "n", "bits")
    sizes = pool.where("live").groupBy("token", "component").agg(F.count("*").alias("k"), F.min(member).alias("m"))
    lead = sizes.groupBy("token").agg(F.max(F.struct("k", "component", "m")).alias("x"))
    lead = lead.select("token", F.col("x.component").alias("lead_component"), F.col("x.m.cls").alias("leader"), F.col("x.m.n").alias("nl"), F.col("x.m.bits").alias("bl"))
    may = f"component <> lead_component and {_SIZES.format('n', 'nl')} and 7 * {_parity('bits', 'bl')} <= n + nl"
    met = pool.where("live").join(lead, "token").where(may)
    first = F.col("leader") < F.col("cls")
    pair = [F.when(first, F.col(x)).otherwise(F.col(y)) for x, y in (("leader", "cls"), ("cls", "leader"), ("lead_component", "component"), ("component", "lead_component"))]
    return met.select(*[c.alias(n) for c, n in zip(pair, ("a", "b", "ca", "cb"), strict=True)]).distinct()


def _led(pool: DataFrame, sets: DataFrame, answers: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rounds of new leaders over the mixed lists: the lists that stay mixed, all answers, and the links found here."""
    links = answers.select("a", "b").limit(0)
    for round_no in range(1, MOST_ROUNDS + 1):
        pairs = materialize(_next_leaders(pool, round_no).join(answers.select("a", "b"), ["a", "b"], "left_anti"), "shingle-leaders")
        found = materialize(_compared(pairs.select("a", "b"), sets), "shingle-answers")
        answers = answers.unionByName(found)
        linked = found.where("linked").select("a", "b")
        if linked.isEmpty():
            break
        links = links.unionByName(linked)
        merged = connected_components(pairs.join(linked, ["a", "b"]).select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        moved = pool.drop("live").join(merged.select(F.col("node").alias("component"), F.col("component").alias("into")), "component", "left")
        moved = moved.withColumn("moved", F.col("into").isNotNull()).withColumn("component", F.coalesce("into", "component")).drop("into")
        # a list without a merge is left to the derived comparison
        lists = moved.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.max("moved").alias("live")).where("lo <> hi")
        pool = materialize(moved.drop("moved").join(lists.select("token", "live"), "token"), "shingle-mixed")
        if pairs.count() <= FEW_PAIRS:
            break
    return pool.drop("live"), answers, links


def _edges(sets: DataFrame) -> DataFrame:
    """Pairs (a, b) that connect all linked classes: each with the name of its component under the first leaders, and later links."""
    entries = sets.select("cls", "n", "shared", "bits", F.posexplode("prefix").alias("pos", "token"))
    lead = entries.groupBy("token").agg(F.min(F.struct("cls", "n")).alias("l"), F.count("*").alias("k")).where("k > 1")
    lead = lead.select("token", F.col("l.cls").alias("leader"), F.col("l.n").alias("nl"))
    lists = materialize(entries.join(lead, "token"), "shingle-lists")
    stars = lists.where("cls <> leader").where(_SIZES.format("n", "nl")).select(F.col("leader").alias("a"), F.col("cls").alias("b")).distinct()
    answers = materialize(_compared(stars, sets), "shingle-answers")
    label = connected_components(answers.where("linked").select("a", "b"))

    told = lists.join(label.select(F.col("node").alias("cls"), "component"), "cls", "left")
    known = answers.select(F.col("a").alias("leader"), F.col("b").alias("cls"), "overlap")
    told = told.withColumn("component", F.coalesce("component", "cls")).join(known, ["leader", "cls"], "left")
    # the overlap of a class with the list's leader; unknown where sizes alone ruled a link out
    told = told.withColumn("overlap", F.when(F.col("cls") == F.col("leader"), F.col("n")).otherwise(F.col("overlap")))
    pool = materialize(_mixed_only(told.drop("leader", "nl")).withColumn("live", F.lit(True)), "shingle-mixed")
    pool, answers, links = _led(pool, sets, answers)
    left = _numbered(pool)
    # partners have at most 4/3 of the size: the same block or one of the next two (rounding)
    other = ("cls", "n", "shared", "bits", "pos", "component", "overlap", "before")
    probe = left.select(*[F.col(c).alias(f"{c}2") for c in other], "token", F.col("block").alias("from"))
    probe = probe.withColumn("block", F.explode(F.expr("sequence(from, from + 2)"))).drop("from")
    derived = "least(overlap, overlap2) + least(n - overlap, n2 - overlap2)"
    meet = (
        "component <> component2 and (n2 < n or (n2 = n and cls2 < cls)) and "
        + _SIZES.format("n", "n2")
        + f" and {_links(_PLACES, 'n', 'n2')} and ({_links(derived, 'n', 'n2')} or overlap is null or overlap2 is null)"
        + f" and 7 * {_parity('bits', 'bits2')} <= n + n2"
        + " and not coalesce(arrays_overlap(before, before2), false)"
    )
    pairs = left.alias("x").join(probe.alias("y"), ["token", "block"]).where(meet)
    rest = pairs.select(F.least("cls", "cls2").alias("a"), F.greatest("cls", "cls2").alias("b")).distinct()
    asked = answers.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = rest.join(asked, ["a", "b"], "left_anti")
    more = materialize(_compared(rest, sets), "shingle-rest")
    # the first leaders' links, many to a group, are told by one pair a class: its name there
    told_apart = label.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return told_apart.unionByName(links).unionByName(more.where("linked").select("a", "b"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, cls) for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id reachable by links; null where no row of the component has an id. Rows
    that repeat are reported each and are in one component; null text has no words; other columns are not read; an
    empty table gives no rows.
    """
    index = _index(docs)
    edges = _edges(_sets(index))
    label = connected_components(edges)
    rows = index.where("is_doc").select("doc_id", "cls", "n")
    classes = rows.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("least"))
    placed = classes.join(label.select(F.col("node").alias("cls"), "component"), "cls")
    whole = placed.groupBy("component").agg(F.min("least").alias("whole"))
    linked = placed.join(whole, "component").select("cls", "whole")
    reach = classes.join(linked, "cls", "left").select("cls", F.coalesce("whole", "least").alias("component_id"))
    worded = rows.where("n > 0").join(reach, "cls", "left")
    alone = rows.where("n = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id", "cls"]
    return worded.select(*columns).unionByName(alone.select(*columns))


def one_per_component(docs: DataFrame) -> DataFrame:
    """``docs`` with the document of the smallest doc_id of each component; columns stay.

    Of rows that repeat an id, or have none, one of each component stays as well: they are numbered in the order of
    their ids, rows without one last.
    """
    spark, columns = docs.sparkSession, quoted(docs.columns)
    ids = docs.agg(F.count("*").alias("rows"), F.count_distinct("doc_id").alias("ids")).first()
    if ids["rows"] == ids["ids"]:
        removed = settled(spark, "shingle-removed", lambda: jaccard_components(docs).where("doc_id <> component_id").select("doc_id"))
        return docs.join(removed, "doc_id", "left_anti").select(*columns)
    row, number = fresh(docs.columns, "row"), fresh(docs.columns, "number")
    marked = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    order = marked.select(row, "doc_id").orderBy(F.col("doc_id").asc_nulls_last(), row)
    numbers = materialize(order.select(row, F.monotonically_increasing_id().alias(number)), "numbers")
    named = marked.join(numbers, row)

    def copies() -> DataFrame:
        found = jaccard_components(named.select(F.col(number).alias("doc_id"), "text"))
        return found.where("doc_id <> component_id").select(F.col("doc_id").alias(number))

    removed = settled(spark, "shingle-removed", copies)
    return named.join(removed, number, "left_anti").select(*columns)
