"""Queries against their SQL and the pipeline against its stages, on the smallest test tables."""

import duckdb
import pytest

import corpus_pipeline
from meterproof.llm import pieces
from meterproof.llm.oracles import oracle_sql
from meterproof.llm.queries import queries

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DIR}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_matches(spark, duck, name):
    df = queries()[name](spark, DIR)
    columns = sorted(df.columns)
    found = sorted(tuple(map(repr, row)) for row in df.select(*columns).collect())
    result = duck.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    wanted = sorted(tuple(repr(row[names.index(c)]) for c in columns) for row in result.fetchall())
    assert found == wanted


def test_stages_pass_documents_on(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DIR)
        left = [r.doc_id for r in out.select("doc_id").collect()]
        assert len(left) == len(set(left)) and set(left) <= ids, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert sorted(out.columns) == sorted(docs.columns)
            docs, ids = out, set(left)
    run = corpus_pipeline.run(spark, DIR)
    assert {r.doc_id for r in run.select("doc_id").collect()} == ids


def test_a_rejected_row_leaves_the_others_of_its_id(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    scored = queries()["op10_quality_classifier"](spark, DIR).join(docs, "doc_id").select("text", "predicted", "score")
    best, worst = (scored.orderBy(scored.score.desc(), "text").first(), scored.orderBy("score", "text").first())
    assert best.predicted == 1 and worst.predicted == 0
    item = spark.read.parquet(f"{DIR}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(None, best.text), (None, worst.text), (-1, best.text), (-1, worst.text)]
    test = spark.createDataFrame([(*r, "en", "a", len(r[1])) for r in rows], docs.select("doc_id", "text", "lang", "source", "n_chars").schema)
    left = corpus_pipeline.quality_classifier_stage(spark, docs.select(*test.columns).unionByName(test), DIR)
    found = [tuple(r) for r in left.where("doc_id IS NULL OR doc_id = -1").select("doc_id", "text").collect()]
    assert sorted(found, key=repr) == sorted([(None, best.text), (-1, best.text)], key=repr)
    rows = [(None, item), (None, "clean prose"), (-1, item), (-1, "clean prose")]
    test = spark.createDataFrame([(*r, "en", "a", len(r[1])) for r in rows], test.schema)
    left = corpus_pipeline.decontamination_stage(spark, test, DIR)
    assert sorted((tuple(r) for r in left.select("doc_id", "text").collect()), key=repr) == [(-1, "clean prose"), (None, "clean prose")]


def test_the_last_stage_decodes_what_it_encodes(spark):
    schema = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
    texts = ["clean prose", "", None, "two  blanks\tand é😀"]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in enumerate(texts)], schema)
    wanted = {r.doc_id: r.round_trip for r in pieces.encode_digest(docs).collect()}
    out = corpus_pipeline.sentencepiece_stage(spark, docs, DIR)
    assert {r.doc_id: r.round_trip for r in out.collect()} == wanted and wanted[0] and wanted[1] and wanted[2]
    decoded = {r.doc_id: r.text for r in pieces.decode(out).collect()}
    assert {i: decoded[i] == (t or "") for i, t in enumerate(texts)} == wanted


def test_every_operator_has_a_query():
    assert sorted(queries()) == sorted([f"op{n}_{x}" for n, x in enumerate(
        "token_counts chat_format sharding language_id line_dedup ngram_join sentencepiece decontamination quality_rules quality_classifier spelling_variants conversation_trie toxicity".split(), 1)] + ["pipeline"])
