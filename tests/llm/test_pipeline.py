"""The registered queries and the pipeline against plain Python."""

import array
import zlib

import duckdb
import pytest

import corpus_pipeline
from martforge.llm import knn_quality, packing, quality_rules, registry
from test_documents import brute_components, brute_counts


def test_registered_names():
    names = [n.split("_")[0] for n in registry.queries()]
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{i}" for i in range(1, 14)]
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracles(spark, small_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small_dir}/{t}.parquet'")
    want = con.sql(registry.oracle_sql()[name])
    got = registry.queries()[name](spark, small_dir)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    plain = want.project(", ".join(columns)).fetchall()
    assert sorted(map(repr, plain)) == sorted(repr(tuple(r)) for r in got.select(*columns).collect())


def test_pipeline_stage_by_stage(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    labels = spark.read.parquet(f"{small_dir}/labels.parquet")

    one = stages["quality classifier"](spark, docs, small_dir).cache()
    scores = {r.doc_id: r.score for r in knn_quality.score_quality(docs, knn_quality.train(docs, labels)).collect()}
    assert {r.doc_id for r in one.collect()} == {d for d, s in scores.items() if s >= 0.7}
    assert one.columns == docs.columns

    two = stages["quality rules"](spark, one, small_dir).cache()
    rules = quality_rules.learn_rules(one, labels)
    fired = {r.doc_id for r in quality_rules.judge(one, rules).where("rule IS NOT NULL").collect()}
    good = {r.doc_id for r in one.collect() if (c := brute_counts(r.text))[0] >= 50 and 100 * c[4] <= 50 * c[0]}
    assert {r.doc_id for r in two.collect()} == good - fired

    three = stages["near duplicates"](spark, two, small_dir).cache()
    groups = brute_components([(r.doc_id, r.text) for r in two.collect()], 5, 80)
    assert sorted(r.doc_id for r in three.collect()) == sorted({c for _, c in groups.values()})

    four = stages["benchmark decontamination"](spark, three, small_dir).cache()
    items = [" ".join(r.text.split()) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in three.collect() if not any(i in " ".join(r.text.split()) for i in items)}
    assert {r.doc_id for r in four.collect()} == clean

    encoder = packing.byte_bpe(*packing.vocabulary())
    whole = {r.doc_id: encoder.ids(r.text) + b"\0\0\0\0" for r in four.collect()}
    pieces = {}
    for r in stages["packing"](spark, four, small_dir).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32))
    assert set(pieces) == set(whole)
    for doc, got in pieces.items():
        at = 0
        for start, length, crc in sorted(got):
            assert start == at and zlib.crc32(whole[doc][4 * at : 4 * (at + length)]) == crc
            at += length
        assert at == len(array.array("I", whole[doc]))
    rows = corpus_pipeline.run(spark, small_dir)
    assert {r.doc_id for r in rows.collect()} == clean


def test_near_duplicates_are_named_by_row(spark, small_dir):
    """Different texts under one id, or without an id, all stay; copies go."""
    texts = [" ".join(f"w{i}x{k}" for k in range(60)) for i in range(4)]
    rows = [(1, texts[0], "a"), (1, texts[1], "b"), (None, texts[2], "c"), (None, texts[3], "d"), (None, texts[3], "e")]
    rows += [(5, texts[1], "f"), (None, texts[0], "g"), (6, "", "h"), (7, None, "i"), (6, "", "j")]
    stage = dict(corpus_pipeline.STAGES)["near duplicates"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string")
    got = stage(spark, docs.withColumnRenamed("_row", "row"), small_dir)
    assert got.columns == ["doc_id", "text", "row"]
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)
    assert kept == sorted([(1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[3]), (6, ""), (7, None)], key=repr)


def test_decontamination_decides_by_row(spark, small_dir):
    """A contaminated row goes though it has no id, and a clean one with its id stays."""
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").limit(100).collect()
    item = next(r.text for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect() if len(r.text.split()) > 20)
    clean = "a plain text of some words that no benchmark item holds"
    rows = [(r.doc_id, r.text) for r in docs] + [(-1, clean), (-1, item), (None, clean + " " + item), (None, clean)]
    stage = dict(corpus_pipeline.STAGES)["benchmark decontamination"]
    got = [tuple(r) for r in stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), small_dir).collect()]
    assert sorted((t for i, t in got if i in (-1, None))) == [clean, clean]
    assert (None, clean) in got and (-1, clean) in got


def test_pipeline_stands_odd_rows(spark, clash, small_dir):
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, clash, small_dir)
        out.collect()
