"""Decontamination leaves nothing out: short items are found, every passage is in the space."""

import numpy as np
import pyarrow as pa

from martforge.llm import decontamination


def test_short_items_are_found_word_by_word(spark):
    docs = spark.createDataFrame(
        [(1, "we ask: Who wrote “Faust”? and go on"), (2, "who wrote the famous Faust"), (3, "wrote Faust"), (4, "Faust - wrote it"), (5, None), (6, "who"),
         (7, "wrote"), (8, "who wrote faust who wrote faust")], "doc_id long, text string")
    bench = spark.createDataFrame([(10, "Who wrote Faust?"), (11, "faust"), (12, "wrote it"), (13, "..."), (14, None)], "item_id long, text string")
    got = decontamination.find_contamination(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 10), (1, 11), (2, 11), (3, 11), (4, 11), (4, 12), (8, 10), (8, 11)]
    assert all(r.lcs_words == r.item_words and r.answer_found and r.cosine <= 1.001 for r in got)
    assert {(r.doc_id, r.window_start) for r in got if r.item_id == 10} == {(1, 2), (8, 0)}


def test_short_and_long_items_are_found_together(spark):
    long = " ".join(f"long{i}" for i in range(20))
    docs = spark.createDataFrame([(1, f"a b {long} c"), (2, "x short one y"), (3, f"short one {long}")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, long), (2, "short one")], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontamination.find_contamination(docs, bench).collect()) == [(1, 1), (2, 2), (3, 1), (3, 2)]


def test_every_passage_is_in_the_sketch(spark):
    """Also those after the first of a text, and those beyond the rows of the sketch."""
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(100))) for i in range(30)] + [(99, None), (100, "")]
    corpus = decontamination.corpus_terms(spark.createDataFrame(rows, "doc_id long, text string")).cache()
    idf = decontamination.inverse_frequencies(corpus)
    want = {t for _, text in rows for t in decontamination.terms_of((text or "").split()).tolist()}
    for most in (1, 7, 10_000):
        out = decontamination.sketch(corpus, idf, most).collect()
        assert len(out) <= most + corpus.rdd.getNumPartitions()
        # Terms of two passages of equal weight may cancel out.
        assert len(want - {t for r in out for t in np.frombuffer(r.terms, "<u2").tolist()}) <= 0.01 * len(want)


def test_sums_have_the_products_of_the_passages():
    r = np.random.default_rng(1)
    terms = r.integers(0, 50, 3200).astype(np.int32)
    raw = decontamination.in_passages(terms, np.array([0, 1000, 3200])).astype("<u2").tobytes()
    idf = np.ones(decontamination.BUCKETS, np.float32)

    def gram(keys, together):
        out = np.zeros((50, 50))
        for key in keys:
            for ids, w in decontamination.signed_sums(iter([(key, raw)]), idf, together):
                row = np.zeros(50)
                row[ids] = w
                out += np.outer(row, row) * together / len(keys)
        return out

    exact, near = gram([0], 1), gram(range(400), 5)
    assert np.abs(near - exact).max() < 0.1 * exact.max()


def test_queries_reach_the_last_words_of_an_item():
    item = decontamination.make_item(1, " ".join(f"w{i}" for i in range(80)))
    space = np.zeros((decontamination.BUCKETS + 1, 1), np.float32)
    space[decontamination.terms_of(list(item.words[-1:]))] = 1
    vectors = decontamination.query_vectors([item], space)[0]
    assert vectors.max() > 0


def test_punctuation_beyond_ascii_is_no_part_of_a_word():
    said = pa.array(["“faust”", "«faust»", "fau…st", "“", "faust", "", "é«"])
    terms = decontamination.hash_words(said).tolist()
    assert terms[0] == terms[1] == terms[2] == terms[4] == decontamination.terms_of(["faust"])[0]
    assert terms[3] == terms[5] == decontamination.BUCKETS and terms[6] == decontamination.terms_of(["é"])[0]
