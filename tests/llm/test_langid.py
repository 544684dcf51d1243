import itertools
import time
import zlib

import numpy as np
import pytest

from ratingloom.llm import langid


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    k, potentials = 3, rng.random((6, 3)) + 0.1
    steps, first = rng.normal(size=(3, 3)), rng.normal(size=3)
    sequences = [[0, 1, 2, 3], [4], [5, 0], [2, 2, 2]]
    ids, lengths = np.concatenate(sequences), np.array([len(s) for s in sequences])
    marginals, expected = langid.posteriors(potentials, ids, lengths, steps, first)
    at, want_moves = 0, np.zeros((k, k))
    for s in sequences:
        weights, total = np.zeros((len(s), k)), 0
        moves = np.zeros((k, k))
        for path in itertools.product(range(k), repeat=len(s)):
            w = np.exp(first[path[0]]) * np.prod([potentials[i, y] for i, y in zip(s, path)])
            w *= np.exp(sum(steps[a, b] for a, b in zip(path, path[1:])))
            total += w
            for t, y in enumerate(path):
                weights[t, y] += w
            for a, b in zip(path, path[1:]):
                moves[a, b] += w
        assert np.allclose(marginals[at : at + len(s)], weights / total)
        want_moves += moves / total
        at += len(s)
    assert np.allclose(expected, want_moves)


@pytest.fixture(scope="module")
def field(small):
    return langid.fit(small)


def test_held_out_accuracy(small, field):
    rows = langid.identify(small, field).join(small.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 40
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1


def test_held_out_documents_and_other_columns_teach_nothing(small, field):
    from pyspark.sql import functions as F

    spoiled = small.withColumn("source", F.lit("z")).withColumn(
        "lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit("zz")).otherwise(F.col("lang"))
    )
    again = langid.fit(spoiled)
    assert again.languages == field.languages and np.array_equal(again.table, field.table)


def test_words_of_a_switching_text_get_their_own_language(spark, small, field):
    texts = {r.lang: r.text for r in small.filter("n_chars > 400").collect()}
    parts = [langid.words_of(texts[lang])[:30] for lang in ("en", "de", "en")]
    docs = spark.createDataFrame([(1, " ".join(sum(parts, [])))], "doc_id long, text string")
    rows = sorted(langid.label_words(docs, field).collect(), key=lambda r: r.position)
    truth = ["en"] * 30 + ["de"] * 30 + ["en"] * 30
    assert [r.word for r in rows] == sum(parts, [])
    assert sum(r.lang == t for r, t in zip(rows, truth)) >= 78


def test_odd_rows(odd, field):
    rows = langid.identify(odd, field).collect()
    assert len(rows) == odd.count()
    for r, source in zip(sorted(rows, key=str), sorted(odd.select("doc_id", "text").collect(), key=str)):
        assert r.score <= 1
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    for empty in (2, 3, 4, 7):
        assert (by_id[empty].lang_pred, by_id[empty].score) == ("und", 0.0)
    assert by_id[5].lang_pred in field.languages
    assert not any(r.held_out for r in rows if r.doc_id is None)
    kept = langid.keep_identified(odd, field)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} <= {1, 5, 6, 8, None}
    assert all(r.lang is not None for r in kept.collect())


def test_nothing_to_learn_from(empty, odd):
    assert langid.fit(empty) is None
    assert langid.identify(empty, None).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, None).collect()} == {"und"}
    assert langid.keep_identified(odd, None).count() == 0


def test_training_on_wordless_texts_gives_nothing():
    assert langid.train(["123", ""], ["en", "de"]) is None


def test_pieces_give_the_marginals_of_whole_sequences():
    rng = np.random.default_rng(11)
    potentials = rng.random((50, 3)) ** 4 + 1e-6
    steps, first = rng.normal(size=(3, 3)) * 2, rng.normal(size=3)
    lengths = np.array([1, 7, 8, 9, 40, 1, 63, 16, 200])
    ids = rng.integers(0, 50, lengths.sum())
    whole = langid.posteriors(potentials, ids, lengths, steps, first)[0]
    for piece in (1, 2, 8, 64, 500):
        assert np.allclose(langid.piecewise_posteriors(potentials, ids, lengths, steps, first, piece), whole, atol=1e-9)
    assert len(langid.piecewise_posteriors(potentials, ids[:0], lengths[:0], steps, first)) == 0


def test_long_text_takes_time_in_proportion():
    texts = [" ".join(f"wort{i % 97} der die das" for i in range(60)), " ".join(f"word{i % 89} the of and" for i in range(60))]
    field = langid.train(texts * 4, ["de", "en"] * 4)
    start = time.perf_counter()
    many = langid._predictions(field, [texts[1]] * 4000)
    middle = time.perf_counter()
    one = langid._predictions(field, [" ".join([texts[1]] * 4000)])
    assert time.perf_counter() - middle < 5 * (middle - start) + 1
    assert set(many[0]) == {"en"} == set(one[0])
