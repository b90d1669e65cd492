"""Merkle manifest of a dataset, with nested-interval labels in place of pointers.

Every row is a leaf. The rows of a group (a source) form a tree of at most ``FANOUT`` children per node, in the order of
their ids, and the tops of all groups form one more tree in the order of the groups, whose top is the root. A node is
labelled with the interval ``[lo, hi)`` of the leaf ranks that it covers, so a leaf's ancestors are the nodes whose
interval contains its own, and the siblings met on the way up are the parent's interval less the interval that the way
comes from.

*Building.* ``BAND`` levels form a bucket: nodes of its lowest level meet by the cell ``lo div FANOUT ** (level + BAND)``,
at most ``FANOUT ** BAND`` of them, and all levels of the bucket are hashed in that row. Rows shrink by that factor per
bucket, so a tree of any size takes a few shuffles, and a group that holds a third of all rows is as many cells.

*Proving.* From the top bucket down, entries (the nodes of the lowest level) join their cell, take the nodes that contain
them as ancestors, note the siblings left and right of them, and inherit the steps of the bucket above. Steps travel once
per cell until the last join, after which a leaf's whole proof is folded in place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdure.operators.ranking import global_rank, running_total
from verdure.operators.skew import ROWS_PER_SALT, salted_lookup
from verdure.session import materialize

FANOUT, BAND = 3, 3
CELL = FANOUT**BAND
#: Columns of a document that its leaf covers.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_STEPS = "array<struct<left:string,right:string>>"


def hashed(*inputs: Column) -> Column:
    """Lowercase hex SHA-256 of the inputs, one after the other; digests go in as hex text."""
    return F.sha2(F.concat(*inputs).cast("binary"), 256)


def leaf_digest(columns: dict[str, Column]) -> Column:
    """Digest of the named values: ``-`` where null, else UTF-8 byte count, ``:``, value."""
    parts = []
    for value in columns.values():
        text = value.cast("string")
        parts.append(F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return hashed(*parts)


def fields_of(docs: DataFrame, **changed: Column) -> dict[str, Column]:
    """The columns of ``docs`` that a leaf covers, some of them ``changed``."""
    return {name: changed.get(name, docs[name]) for name in FIELDS}


@dataclass
class Manifest:
    """Leaves, buckets of nodes and the root of a dataset.

    ``leaves`` (tree, height, lo, hi, digest, group, doc_id, carried ...), ``bands[b]`` (tree, height, cell, nodes),
    ``groups`` (tree, height, digest, group), the trees of the groups' tops in ``crown``, ``root`` a digest, null
    for an empty dataset.
    """

    leaves: DataFrame
    bands: list[DataFrame]
    groups: DataFrame
    crown: list[DataFrame]
    root: str | None

    def nodes(self) -> DataFrame:
        """(tree, level, lo, hi, digest) of all nodes above the leaves, those of the groups' tops under a null tree."""
        own = [_exploded(b).select("tree", "level", "lo", "hi", "digest") for b in self.bands]
        own += [_exploded(b).select(F.lit(None).cast("long").alias("tree"), "level", "lo", "hi", "digest") for b in self.crown]
        empty = self.leaves.select("tree", F.lit(0).alias("level"), "lo", "hi", "digest").where("false")
        for part in own:
            empty = empty.unionByName(part)
        return empty

    def proofs(self) -> DataFrame:
        """Leaves with ``subroot``, the digest of their group's top, and ``steps``, the siblings from the leaf to the root."""
        tops = self.groups.select(F.lit(0).cast("long").alias("tree"), "tree_height", F.col("tree").alias("lo"), (F.col("tree") + 1).alias("hi"), "digest", F.col("tree").alias("group_tree"), "height")
        crown = tops.withColumnRenamed("height", "own_height").withColumnRenamed("tree_height", "height")
        start = self.groups.groupBy(F.lit(0).cast("long").alias("tree")).agg(
            F.max("tree_height").alias("height"), F.array().cast(_STEPS).alias("above"), F.lit(self.root).cast("string").alias("top")
        )
        above = _proved(crown, self.crown, start).select(
            F.col("group_tree").alias("tree"), F.col("own_height").alias("height"), F.col("steps").alias("above"), F.col("digest").alias("top")
        )
        return _proved(self.leaves, self.bands, materialize(above, "merkle-tops")).withColumnRenamed("top", "subroot")


def manifest(docs: DataFrame, group: str = "source", carried: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs`` (doc_id, text, lang, source, n_chars), with ``carried`` columns kept beside the leaves.

    Within a group leaves ascend by doc_id (null first), then by digest; rows that repeat are leaves each, in a fixed but
    arbitrary order. A null group is a group of its own and comes first; groups go by their UTF-8 bytes. Null text and
    empty text differ; other columns are not read; an empty table has no leaves and no root.
    """
    extra = carried or {}
    rows = docs.select(
        # null sorts before every name, and keys are never null
        F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit("")).alias("key"),
        F.col(group).cast("string").alias("group"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(fields_of(docs)).alias("digest"),
        *[c.alias(n) for n, c in extra.items()],
        F.monotonically_increasing_id().alias("row"),
    )
    rows = materialize(rows, "merkle-rows")
    ranked = materialize(global_rank(rows, ["key", "doc_id", "digest", "row"], "rank"), "merkle-ranked")
    counts = ranked.groupBy("key").agg(F.count("*").alias("n"), F.first("group").alias("group"))
    counts = materialize(global_rank(running_total(counts, ["key"], F.col("n"), "upto"), ["key"], "number"), "merkle-groups")
    size = counts.agg(F.max("n").alias("most"), F.count("*").alias("groups")).first()
    salts = max(1, -(-(size["most"] or 0) // ROWS_PER_SALT))
    named = counts.select("key", (F.col("number") - 1).alias("tree"), _height(F.col("n")).alias("height"), (F.col("upto") - F.col("n")).alias("before"))
    placed = salted_lookup(ranked, named, ["key"], by=["row"], salts=salts)
    lo = F.col("rank") - 1 - F.col("before")
    leaves = materialize(placed.select("tree", "height", lo.alias("lo"), (lo + 1).alias("hi"), "digest", "group", "doc_id", *extra), "merkle-leaves")
    bands = _bands(leaves)
    tops = _tops(leaves, bands).join(counts.select((F.col("number") - 1).alias("tree"), "group"), "tree")
    groups = materialize(tops.withColumn("tree_height", _height(F.lit(size["groups"]))), "merkle-subroots")
    crown_leaves = groups.select(F.lit(0).cast("long").alias("tree"), F.col("tree_height").alias("height"), F.col("tree").alias("lo"), (F.col("tree") + 1).alias("hi"), "digest")
    crown = _bands(crown_leaves)
    top = _tops(crown_leaves, crown).first()
    return Manifest(leaves, bands, groups, crown, top["digest"] if top else None)


def _height(count: Column) -> Column:
    """Levels above the leaves of a tree: the least h with ``FANOUT ** h >= count``."""
    return F.size(F.filter(F.sequence(F.lit(0), F.lit(35)), lambda k: F.pow(F.lit(float(FANOUT)), k) < count))


def _bands(leaves: DataFrame) -> list[DataFrame]:
    """The buckets of levels over ``leaves``, lowest first."""
    tallest = leaves.agg(F.max("height")).first()[0] or 0
    bands: list[DataFrame] = []
    entries = leaves.where("height > 0")
    for low in range(0, tallest, BAND):
        bands.append(materialize(_band(entries, low), "merkle-band"))
        entries = _entries(bands[-1], low + BAND)
    return bands


def _band(entries: DataFrame, low: int) -> DataFrame:
    """(tree, height, cell, nodes): all nodes of the levels above ``low`` of the bucket, by cell."""
    cell = F.expr(f"lo div {FANOUT ** (low + BAND)}")
    # at most CELL entries meet in a row
    kids = F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("x0")
    rows = entries.groupBy("tree", "height", cell.alias("cell")).agg(kids)
    for k in range(1, BAND + 1):
        rows = rows.withColumn(f"x{k}", _above(f"x{k - 1}", low + k))
    whole = F.filter(F.flatten(F.array(*[F.col(f"x{k}") for k in range(1, BAND + 1)])), lambda x: x["level"] <= F.col("height"))
    return rows.select("tree", "height", "cell", whole.alias("nodes"))


def _above(children: str, level: int) -> Column:
    """The parents of an array of nodes in order."""
    bare = f"transform({children}, x -> struct(x.lo as lo, x.hi as hi, x.digest as digest))"
    runs = f"transform(sequence(0, (size({children}) - 1) div {FANOUT}), i -> slice({bare}, i * {FANOUT} + 1, {FANOUT}))"
    return F.expr(
        f"transform({runs}, r -> struct({level} as level, r[0].lo as lo, element_at(r, -1).hi as hi, "
        "sha2(cast(array_join(transform(r, x -> x.digest), '') as binary), 256) as digest, r as children))"
    )


def _exploded(band: DataFrame) -> DataFrame:
    return band.select("tree", "height", F.explode("nodes").alias("x")).select("tree", "height", "x.*")


def _entries(band: DataFrame, level: int) -> DataFrame:
    """Nodes of one level that are not their tree's top."""
    return _exploded(band).where((F.col("level") == level) & (F.col("height") > level)).select("tree", "height", "lo", "hi", "digest")


def _tops(leaves: DataFrame, bands: list[DataFrame]) -> DataFrame:
    """(tree, height, digest) of the top node of every tree."""
    tops = leaves.where("height = 0").select("tree", "height", "digest")
    for band in bands:
        tops = tops.unionByName(_exploded(band).where("level = height").select("tree", "height", "digest"))
    return tops


def _proved(leaves: DataFrame, bands: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``leaves`` with ``steps`` to the root and ``top``; ``tops`` (tree, height, above, top) has what follows a tree's own top."""
    inherited = None
    for b in range(max(len(bands), 1) - 1, -1, -1):
        low = b * BAND
        ends = (F.col("height") <= low + BAND) & ((F.col("height") > low) | F.lit(b == 0))
        above = tops.where(ends).select("tree", F.lit(0).cast("long").alias("cell"), "above", "top")
        if inherited is not None:
            above = above.unionByName(inherited)
        if bands:
            cells = above.join(bands[b].select("tree", "cell", "nodes"), ["tree", "cell"], "left")
        else:
            cells = above.withColumn("nodes", F.lit(None).cast("array<struct<lo:bigint,hi:bigint,children:array<struct<lo:bigint,hi:bigint,digest:string>>>>"))
        entries = leaves if b == 0 else _entries(bands[b - 1], low)
        entries = entries.withColumn("cell", F.expr(f"lo div {FANOUT ** (low + BAND)}"))
        # containment within the bucket's cell; the parent's interval less one's own leaves the siblings
        steps = F.expr(
            "transform(filter(coalesce(nodes, array()), a -> a.lo <= lo and a.hi >= hi), a -> struct("
            "array_join(transform(filter(a.children, c -> c.hi <= lo), c -> c.digest), '') as left, "
            "array_join(transform(filter(a.children, c -> c.lo >= hi), c -> c.digest), '') as right))"
        ).cast(_STEPS)
        joined = entries.join(cells, ["tree", "cell"]).withColumn("steps", F.concat(steps, "above"))
        if b == 0:
            return joined.drop("cell", "nodes", "above")
        cell = F.expr(f"lo div {FANOUT**low}").alias("cell")
        inherited = materialize(joined.select("tree", cell, F.col("steps").alias("above"), "top"), "merkle-steps")
    raise AssertionError


def proof_digest(steps: str = "steps") -> Column:
    """Digest of all siblings of a proof, level by level, left to right."""
    return F.expr(f"sha2(cast(array_join(transform({steps}, s -> concat(s.left, s.right)), '') as binary), 256)")


def fold(leaf: str, steps: str = "steps") -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.expr(f"aggregate({steps}, {leaf}, (acc, s) -> sha2(cast(concat(s.left, acc, s.right) as binary), 256))")


def verify(docs: DataFrame, known: Manifest) -> DataFrame:
    """(doc_id, group, verified) of every leaf that ``known`` has: whether ``docs`` still has a row of that id and group that leads to the root.

    A leaf whose row was changed or removed is not verified. Rows that ``docs`` has in addition are not reported.
    """
    now = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("group"), leaf_digest(fields_of(docs)).alias("now")).distinct()
    old = known.proofs()
    same = (old["doc_id"].eqNullSafe(now["doc_id"])) & (old["group"].eqNullSafe(now["group"])) & (old["digest"] == now["now"])
    met = old.join(now, same, "left").select(old["doc_id"], old["group"], "now", "steps")
    return met.select("doc_id", "group", F.coalesce(fold("now") == F.lit(known.root), F.lit(False)).alias("verified"))


def tamper_check(docs: DataFrame, tampered: Column, chosen: Column) -> DataFrame:
    """Every row's leaf, subroot, root and proof, and the root that the row leads to once ``chosen`` rows have ``tampered`` as text."""
    leaf = leaf_digest(fields_of(docs, text=tampered))
    changed = F.when(chosen & ~tampered.eqNullSafe(F.col("text")), leaf)
    made = manifest(docs, carried={"tampered": changed})
    root = F.lit(made.root).cast("string")
    proved = made.proofs().withColumn("start", F.coalesce("tampered", "digest"))
    folded = proved.select("doc_id", F.col("digest").alias("leaf"), "subroot", root.alias("root"), proof_digest().alias("proof_sha256"), fold("start").alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
