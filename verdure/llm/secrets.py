"""Secret scans over a ledger of content-addressed blobs.

A text is a blob, named by its SHA-256; paths (documents, or versions of them) only point at blobs. The ledger keeps
which (blob, rule, rule version) triples were scanned and what was found. A run names the blobs of its rows, asks the
ledger which of their rules are due, and only then matches: one row of each blob, and only against rules whose version
the blob has not met. Rows of blobs that the ledger knows are never matched, however many paths carry them; findings are
joined back to all paths. Everything is DataFrame expressions.

Texts meet the due blobs on blob and document id, so copies of one text do not gather in a task; clean texts go no
further. Positions come from the lengths of the pieces between matches, summed in order, and count code points; ends are
exclusive. Null text is empty. Rows that repeat are reported each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verdure.llm.common import fresh, new_folder, quoted
from verdure.session import materialize


@dataclass(frozen=True)
class Rule:
    """``pattern`` matches leftmost and without overlap; matches whose ``group`` has fewer than ``least`` characters are dropped."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))

#: In the order in which spans that start together are listed.
RULES = (
    Rule("assign", 1, rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    # runs are taken whole, so asking for the least length in the pattern drops the same matches
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", 0, 20, True),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24, True),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("forge", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
)

#: Ids of rows with findings, up to which all tasks get them to tell the rows to redact; with more, all rows meet their findings by blob.
MOST_SENT = 2_000_000

_FINDINGS = "blob string, kind string, version int, start long, end long"
_SEEN = "blob string, kind string, version int"


class Ledger:
    """What was scanned and found so far, in a folder that all executors reach. Written by appending only.

    Findings are written before the triples that they belong to: a run that breaks off between the two scans those
    blobs again, and reading drops the doubles.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _read(self, name: str, schema: str) -> DataFrame:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        exists = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}") if exists else self.spark.createDataFrame([], schema)

    def seen(self) -> DataFrame:
        return self._read("seen", _SEEN)

    def findings(self) -> DataFrame:
        return self._read("findings", _FINDINGS).distinct()

    def add(self, findings: DataFrame, seen: DataFrame) -> None:
        findings.write.mode("append").parquet(f"{self.folder}/findings")
        seen.write.mode("append").parquet(f"{self.folder}/seen")


def blob_of(text: str = "text") -> Column:
    return F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"), 256)


def suspicious(rules: tuple[Rule, ...] = RULES, text: str = "text") -> Column:
    """Whether any rule may match the text."""
    return F.coalesce(F.col(text).cast("string").rlike("|".join(f"(?:{r.pattern})" for r in rules)), F.lit(False))


def _current(rules: tuple[Rule, ...]) -> Column:
    """Whether a row (kind, version) belongs to one of ``rules``."""
    return F.struct("kind", "version").isin([F.struct(F.lit(r.kind), F.lit(r.version)) for r in rules])


def _lengths(found: Column) -> Column:
    return F.transform(found, lambda x: F.char_length(x).cast("long"))


def _per_rule(rules: tuple[Rule, ...], make) -> Column:
    chosen = F.lit(None)
    for r in rules:
        chosen = F.when(F.col("kind") == r.kind, make(r)).otherwise(chosen)
    return chosen


def locate(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, kind, version, start, end) of all matches in ``blobs`` (blob, text, kind, version)."""
    taken = blobs.select(
        "blob",
        "kind",
        "version",
        F.posexplode(
            F.arrays_zip(
                _lengths(_per_rule(rules, lambda r: F.split("text", r.pattern, -1))).alias("gap"),
                _lengths(_per_rule(rules, lambda r: F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0)))).alias("whole"),
                _lengths(_per_rule(rules, lambda r: F.regexp_extract_all("text", F.lit(r.pattern), F.lit(r.group)))).alias("value"),
            )
        ).alias("no", "x"),
    ).select("blob", "kind", "version", "no", "x.*")
    order = Window.partitionBy("blob", "kind", "version").orderBy("no")
    upto = F.sum("gap").over(order.rowsBetween(Window.unboundedPreceding, 0))
    before = F.coalesce(F.sum("whole").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    least = _per_rule(rules, lambda r: F.lit(r.least))
    return (
        taken.withColumn("start", upto + before)
        .where(F.col("whole").isNotNull() & (F.col("value") >= least))
        .select("blob", "kind", "version", "start", (F.col("start") + F.col("whole")).alias("end"))
    )


def due_blobs(paths: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, least, kinds): blobs of ``paths`` (doc_id, blob) with the rules they have not met and their smallest document id."""
    known = ledger.seen().where(_current(rules)).groupBy("blob").agg(F.collect_set("kind").alias("met"))
    blobs = paths.groupBy("blob").agg(F.min("doc_id").alias("least"))
    every = F.array(*[F.lit(r.kind) for r in rules])
    kinds = F.array_except(every, F.coalesce("met", F.array().cast("array<string>")))
    return blobs.join(known, "blob", "left").select("blob", "least", kinds.alias("kinds")).where(F.size("kinds") > 0)


def due_texts(docs: DataFrame, due: DataFrame) -> DataFrame:
    """(blob, kinds, text) of the rows of ``docs`` that stand for their due blob; more than one only where rows repeat."""
    texts = docs.select(F.col("doc_id").cast("long"), blob_of().alias("blob"), F.col("text").cast("string"))
    here = (F.col("t.blob") == F.col("d.blob")) & F.col("t.doc_id").eqNullSafe(F.col("d.least"))
    return texts.alias("t").join(due.alias("d"), here).select("d.blob", "kinds", "text")


def record(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Bring the ledger up to date with all texts of ``docs``; returns their paths (doc_id, blob)."""
    paths = materialize(docs.select(F.col("doc_id").cast("long"), blob_of().alias("blob")), "secret-paths")
    due = materialize(due_blobs(paths, ledger, rules), "secret-due")
    # one search for all rules passes over clean texts; it hangs on the due rules, or it would be made ahead of the join
    searched = F.when(F.size("kinds") > 0, suspicious(rules))
    dirty = due_texts(docs, due).where(searched).groupBy("blob").agg(F.first("kinds").alias("kinds"), F.first("text").alias("text"))
    version = _per_rule(rules, lambda r: F.lit(r.version))
    hits = dirty.select("blob", "text", F.explode("kinds").alias("kind")).where(_per_rule(rules, lambda r: F.col("text").rlike(r.pattern)))
    ledger.add(
        locate(hits.withColumn("version", version), rules),
        due.select("blob", F.explode("kinds").alias("kind")).withColumn("version", version),
    )
    return paths


def spans_by_blob(ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans) under the current rule versions; spans sorted by start, then by rule."""
    number = _per_rule(rules, lambda r: F.lit(rules.index(r)))
    span = F.struct("start", number.alias("rule_no"), "end", "kind")
    return ledger.findings().where(_current(rules)).groupBy("blob").agg(F.array_sort(F.collect_list(span)).alias("spans"))


def scan(docs: DataFrame, ledger: Ledger | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, blob, spans) for every row of ``docs`` (doc_id, text); spans are empty where nothing was found."""
    ledger = ledger or Ledger(docs.sparkSession, new_folder(docs.sparkSession, "secret-ledger"))
    paths = record(docs, ledger, rules)
    found = materialize(spans_by_blob(ledger, rules).join(paths.select("blob").distinct(), "blob", "left_semi"), "secret-spans")
    none = F.array().cast(found.schema["spans"].dataType)
    return paths.join(found, "blob", "left").select("doc_id", "blob", F.coalesce("spans", none).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kinds(kinds: list[str]) -> Column:
    return F.filter("spans", lambda s: s["kind"].isin(kinds))


def digest(scanned: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans and the list of all spans of every row."""
    base = [r.kind for r in rules if r.base]
    own = _of_kinds(base)
    counts = [F.size(_of_kinds([k])).cast("long").alias(f"n_{k}") for k in base]
    return scanned.select(
        "doc_id", *counts, F.sha2(listed(own).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


def redacted_text(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with every stretch that spans cover replaced by ``mark``; touching or overlapping spans count as one stretch each start."""
    reach = lambda i: F.coalesce(F.array_max(F.slice(F.transform(spans, lambda s: s["end"]), F.lit(1), i)), F.lit(0))

    def kept(span: Column, i: Column) -> Column:
        done = F.when(i == 0, F.lit(0).cast("long")).otherwise(reach(i))
        gap = F.concat(F.substring(text, (done + 1).cast("int"), (span["start"] - done).cast("int")), F.lit(mark))
        return F.when((i == 0) | (span["start"] > done), gap).otherwise(F.lit(""))

    tail = F.substring(text, (F.array_max(F.transform(spans, lambda s: s["end"])) + 1).cast("int"), F.char_length(text))
    return F.concat(F.array_join(F.transform(spans, kept), ""), tail)


def redact(docs: DataFrame, mark: str = "[secret]", ledger: Ledger | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark`` and ``n_chars``, where there is one, counted anew.

    Rows meet their findings by blob, no text is matched for it; columns and their order stay. Ids of paths with findings
    tell the rows that have to meet them, so clean texts are not shuffled; rows without an id are always among them.
    """
    ledger = ledger or Ledger(docs.sparkSession, new_folder(docs.sparkSession, "secret-ledger"))
    paths = record(docs, ledger, rules)
    blob, spans, new, dirty = (fresh(docs.columns, c) for c in ("blob", "spans", "redacted", "dirty"))
    found = spans_by_blob(ledger, rules).join(paths.select("blob").distinct(), "blob", "left_semi")
    found = materialize(found.select(F.col("blob").alias(blob), F.col("spans").alias(spans)), "secret-spans")
    ids = paths.join(found.select(F.col(blob).alias("blob")), "blob").select(F.col("doc_id").alias(dirty)).distinct()
    ids = materialize(ids, "secret-ids")
    row_id = F.col("doc_id").cast("long")
    clean, rows = None, docs
    if ids.count() <= MOST_SENT:
        asked = docs.join(F.broadcast(ids), row_id == F.col(dirty), "left")
        told = F.col(dirty).isNull() & row_id.isNotNull()
        clean, rows = asked.where(told), asked.where(~told)
    met = rows.withColumn(blob, blob_of()).join(found, blob, "left")
    met = met.withColumn(new, F.when(F.col(spans).isNotNull(), redacted_text(F.col("text").cast("string"), F.col(spans), mark)))
    columns, same = [], []
    for c, reference in zip(docs.columns, quoted(docs.columns), strict=True):
        same.append(F.col("text").cast("string").alias(c) if c == "text" else F.col(reference))
        if c == "text":
            columns.append(F.coalesce(new, F.col("text").cast("string")).alias(c))
        elif c == "n_chars":
            counted = F.when(F.col(new).isNotNull(), F.char_length(new)).otherwise(F.col(c))
            columns.append(counted.cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(reference))
    redacted = met.select(*columns)
    return redacted if clean is None else clean.select(*same).union(redacted)
