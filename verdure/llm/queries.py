"""The registered queries of this folder and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdure.llm import automaton, jaccard, language, licenses, merkle, neardup, packing, quality, secrets
from verdure.llm import token_files, topk, toxicity, whitening
from verdure.llm.common import bounded_batches, table
from verdure.llm.sql import SQL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
__all__ = ["QUERIES", "SQL"]


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(bounded_batches(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer lies; the files are never copied."""
    import public_tokenizers

    return public_tokenizers.path(name)


BYTE_BPE, BYTE_VOCABULARY, BYTE_END = "byte_bpe_50k.json", 50_257, 0
WORD_BPE, WORD_VOCABULARY, WORD_END = "word_bpe_49k.json", 49_408, 1


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned outside the held-out fold."""
    found = language.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents by two views that taught each other."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode all documents with the compiled automaton."""
    return automaton.round_trip(table(spark, sf_dir, "documents"), tokenizer_path(WORD_BPE))


@query
def op4_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors with a cosine of 0.95 or more."""
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents, found once per content and joined back to every document."""
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


@query
def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under the similarity of their word shingles."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest inner products of every fiftieth vector with all others."""
    return topk.top_products(table(spark, sf_dir, "embeddings"))


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named or granted in all documents."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as token files, read them back and describe every document."""
    docs = table(spark, sf_dir, "documents")
    manifest = token_files.write_token_files(docs, "byte", tokenizer_path(BYTE_BPE), BYTE_END, BYTE_VOCABULARY)
    return token_files.digests(token_files.read_token_files(manifest))


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences with every source's share in each window."""
    docs = table(spark, sf_dir, "documents")
    pieces = packing.pack(docs, "word", tokenizer_path(WORD_BPE), WORD_END, with_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and root of every document, and the root it leads to once some texts have lost their line ends."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit(""))
    return merkle.tamper_check(docs, tampered, _remainder(2) == 0)


@query
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned outside the held-out fold."""
    held_out = F.coalesce(_remainder(5) == 0, F.lit(False))
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out)


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors projected on their first whitened components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def _remainder(divisor: int) -> Column:
    """The CRC-32 of the decimal doc_id, modulo ``divisor``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(divisor))
