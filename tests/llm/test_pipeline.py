"""The corpus pipeline and the registered queries."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tests.llm.test_pairs import by_shingles
from tests.llm.test_texts import base_spans, junk, written
from verdure.llm import packing
from verdure.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    names = set(queries())
    assert {f"op{n}_" for n in range(1, 11)} <= {n.split("_")[0] + "_" for n in names if n.startswith("op")}
    assert "pipeline" in names and "pipeline" not in oracle_sql()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "secrets", "packing"]


def corpus(seed):
    rng = random.Random(seed)
    rows, good = [], {}
    for i in range(260):
        lang = rng.choice(["en", "de", "fr"])
        good[i] = rng.random() < 0.8
        text = written(rng, lang, rng.randint(15, 90)) if good[i] else junk(rng, lang)
        if good[i] and rng.random() < 0.2:
            text += f" token={rng.getrandbits(128):032x}"
        rows.append((i, text, lang, "s", len(text)))
    clean = [r for r in rows if good[r[0]]]
    for k in range(60):
        base = rng.choice(clean)
        words = base[1].split()
        if k % 2 and len(words) > 40:
            words[rng.randrange(len(words))] = "changed"
        rows.append((300 + k, " ".join(words), base[2], "s", 5))
        good[300 + k] = True
    return rows, good


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    rows, good = corpus(1)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("blob", F.lit(1)).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(g), 0) for i, g in good.items() if i % 3]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), rows, good


def test_stages_against_brute_force(spark, tables):
    folder, rows, good = tables
    by_id = {r[0]: r[1] for r in rows}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    outputs = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        outputs.append([r.asDict() for r in docs.collect()])
        if len(outputs) < 5:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "blob"]
    kept, told, single, clean, packed = outputs
    wrong = {i for i in by_id if (i in {r["doc_id"] for r in kept}) != good[i]}
    assert len(wrong) <= 3 and not {i for i in wrong if good[i]}
    assert {r["doc_id"] for r in told} == {r["doc_id"] for r in kept}
    want = {int(c) for _, _, c in by_shingles([(r["doc_id"], r["text"]) for r in told])}
    assert {r["doc_id"] for r in single} == want and len(want) < len(told)
    assert sorted(r["doc_id"] for r in clean) == sorted(want)
    for r in clean:
        assert not base_spans(r["text"])
        if not base_spans(by_id[r["doc_id"]]):
            assert r["text"] == by_id[r["doc_id"]]
    assert {r["doc_id"] for r in packed} == want
    assert sum(r["length"] for r in packed) == sum({r["doc_id"]: r["doc_tokens"] for r in packed}.values())
    lengths = {}
    for r in packed:
        lengths[r["sequence_id"]] = lengths.get(r["sequence_id"], 0) + r["length"]
    assert all(packing.pad_to(n) == n for n in lengths.values())


def test_run_writes_every_stage(spark, tables):
    folder, rows, good = tables
    out = corpus_pipeline.run(spark, folder)
    assert out.select("doc_id").distinct().count() > 50


def test_stages_on_empty_and_odd_tables(spark, tables, make_docs, odd_texts):
    folder = tables[0]
    odd = [(i, t, None if i % 2 else "en", None if i % 3 else "s", None) for i, t in enumerate(odd_texts)] + [(None, None, None, None, None), (2, "x", "en", "s", 1)]
    for docs in (make_docs(odd, clashing=True), make_docs(odd).limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            out = stage(spark, docs, folder)
            assert out.count() >= 0
            assert out.columns == columns or stage is corpus_pipeline.packed


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")
@pytest.mark.parametrize("name", QUERIES)
def test_queries_have_a_row_for_every_document_or_vector(spark, name):
    got = QUERIES[name](spark, SF_DIR)
    ids = {"op4_embedding_neardup": "vec_id", "op7_exact_topk": "query_id"}.get(name, "doc_id")
    table = "embeddings" if ids != "doc_id" else "documents"
    source = spark.read.parquet(f"{SF_DIR}/{table}.parquet")
    want = source.count() if ids != "query_id" else source.where("vec_id % 50 = 0").count()
    assert got.select(ids).distinct().count() == want


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")
def test_whitening_has_every_usable_vector(spark):
    usable = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").where("forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    got = QUERIES["op13_whitening"](spark, SF_DIR)
    assert {(r.vec_id, r.component) for r in got.collect()} == {(r.vec_id, k) for r in usable.collect() for k in range(1, 5)}
