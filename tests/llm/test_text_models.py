"""Language, quality and token counts."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.helpers import VOCABULARY, documents, odd, small
from tokenizers import Tokenizer

from shelfcast.llm import language, quality, token_count
from shelfcast.llm.queries import QUERIES


def test_bound_trigrams_are_bundled_as_defined():
    first, second, third = language._letter_vectors(128, 3)
    vectors, letters = language.document_vectors(["Ab", "", "é"], 128, 3)
    a, b, edge = 1, 2, 0
    expected = first[edge] * second[a] * third[b] + first[a] * second[b] * third[edge]
    assert (vectors[0] == expected).all() and letters.tolist() == [2, 0, 1]
    assert not vectors[1].any()


def test_language_held_out_accuracy(spark):
    found = QUERIES["op1_language_id"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 200
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)
    assert all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_language_of_odd_rows(spark):
    docs = odd(spark)
    profiles = language.fit_profiles(docs, dimensions=256)
    rows = language.identify(docs, profiles).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "fr") and 0 <= r.score <= 1
    nothing = language.fit_profiles(docs.where("lang is null"), dimensions=64)
    assert nothing.languages == ()
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(docs.limit(0), profiles).count() == 0


def test_quality_held_out_ranking(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = QUERIES["op2_quality_scores"](spark, folder).join(labels, "doc_id").where("held_out").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    wins = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert wins > 0.95
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)


def test_ridge_solves_the_normal_equations_of_all_rows(spark):
    random = np.random.default_rng(0)
    stats = random.normal(size=(300, len(quality.STATISTICS)))
    labels = (stats[:, 3] > 0).astype(float)
    rows = spark.createDataFrame(
        [(s.tolist(), float(y), i % 4 == 0) for i, (s, y) in enumerate(zip(stats, labels))],
        "stats array<double>, label double, later boolean",
    ).repartition(5)
    model = quality.fit(rows, F.col("later"), features=32, penalty=1e-3)
    early = np.arange(300) % 4 != 0
    x = model.features(stats[early])
    ridge = np.eye(33) * 1e-3 * early.sum()
    ridge[-1, -1] = 0
    assert np.allclose(model.weights, np.linalg.solve(x.T @ x + ridge, x.T @ labels[early]), atol=1e-6)
    assert (np.diff(model.levels) >= 0).all()


def test_pooled_means_are_monotone():
    blocks = quality._pooled([2, 2, 2, 1], [1, 2, 0, 1])
    assert [(b[0], b[1], b[2]) for b in blocks] == [(6, 3, 3), (1, 1, 1)]


def test_quality_of_odd_rows(spark):
    docs = odd(spark)
    stats = quality.with_statistics(docs)
    assert stats.columns == [c for c in docs.columns if c != "text"] + ["stats"]
    untaught = quality.fit(stats.withColumn("label", F.lit(None).cast("double")), F.lit(False))
    rows = quality.score(stats, untaught).collect()
    assert len(rows) == docs.count() and {r.score for r in rows} == {0.5}
    taught = quality.fit(stats.withColumn("label", F.lit(1.0)), F.lit(False))
    assert all(0 <= r.score <= 1 for r in quality.score(stats, taught).collect())
    assert quality.score(stats.limit(0), taught).count() == 0


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def test_token_counts_of_a_table(spark, library):
    rows = token_count.count_tokens(small(spark), VOCABULARY).collect()
    ids = library.encode_batch([r.text or "" for r in rows], add_special_tokens=False)
    assert [r.n_tokens for r in rows] == [len(x.ids) for x in ids]
    assert all(r.n_bytes == len(r.text.encode()) and r.over_limit == (r.n_tokens > 512) for r in rows)


def test_token_counts_of_odd_texts(spark, library):
    texts = ["", None, "a" * 5000, "<|endoftext|>x<|endoftext|>", "it's  \n\n they'll\t", "日本語 ümläut 😀😀", "\x00\x1c\x85", "\n" * 40]
    rows = documents(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    found = {r.doc_id: r.n_tokens for r in token_count.count_tokens(rows, VOCABULARY).collect()}
    assert found == {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
    assert token_count.count_tokens(odd(spark), VOCABULARY).count() == odd(spark).count()
    assert token_count.count_tokens(rows.limit(0), VOCABULARY).count() == 0


def test_forgetting_words_changes_no_count(library, monkeypatch):
    monkeypatch.setattr(token_count, "KEPT_WORDS", 3)
    merger = token_count.PairMerger(VOCABULARY)
    text = "several different words and several more different words"
    assert merger.count(text) == len(library.encode(text).ids)
    assert len(merger.seen) <= 3
