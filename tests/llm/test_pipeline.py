"""Every stage on what its predecessor kept, against brute force."""

import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline
from ratingloom.llm import secrets
from ratingloom.session import durable
from test_minhash import brute_force
from test_mixing import size, water_fill


@pytest.fixture(scope="module")
def stages(spark, small, odd):
    planted = "The committee of the region met in the morning and read the letter with password = hunter22 in it"
    planted = spark.createDataFrame([(2000, planted, "en", "src1", 1), (2001, "Of " + planted.replace("p", "%70"), "en", "src2", 1)], small.schema)
    docs = small.unionByName(odd.selectExpr("doc_id + 1000 as doc_id", "text", "lang", "source", "n_chars")).union(planted)
    docs = durable(docs, "stage-input")
    results = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = durable(stage(spark, docs, "unused"), f"stage-{name}")
        results.append(docs)
    return results


def rows(df):
    return [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect()]


def test_language_keeps_what_has_a_language(stages):
    before, after = rows(stages[0]), rows(stages[1])
    assert stages[1].columns == stages[0].columns
    kept = {r[0] for r in after}
    for r in before:
        if not any(c.isalpha() for c in r[1] or ""):
            assert r not in after
        elif r[0] is not None and r[0] < 1000:
            assert r[0] in kept
    assert all(lang is not None for _, _, lang, _, _ in after)


def test_one_of_each_group_of_near_duplicates_stays(stages):
    before = rows(stages[1])
    kept = {(i, t) for (i, _, _, k) in brute_force([r[:2] for r in before]) if k for t in [r[1] for r in before if r[0] == i]}
    assert sorted((r[:2] for r in rows(stages[2])), key=str) == sorted(kept, key=str)


def test_secrets_are_masked_and_nothing_else_changes(stages):
    before, after = {r[0]: r for r in rows(stages[2])}, {r[0]: r for r in rows(stages[3])}
    assert before.keys() == after.keys()
    masked = 0
    for i, row in before.items():
        found = secrets.scan_layers(row[1])
        if not found:
            assert after[i][:4] == row[:4]
        else:
            masked += 1
            assert "[SECRET]" in after[i][1]
            for start, _, end, _ in found:
                assert row[1][start:end] not in after[i][1]
        assert after[i][4] == len(after[i][1]) and after[i][2:4] == row[2:4]
    assert masked


def test_mixture_comes_near_its_targets(stages):
    before, after = rows(stages[3]), rows(stages[4])
    sizes, taken = {}, {}
    for table, sums in ((before, sizes), (after, taken)):
        for r in table:
            sums[r[3]] = sums.get(r[3], 0) + size(r[1])
    assert set(after) <= set(before)
    assert all(after.count(r) <= 2 * before.count(r) for r in set(before))
    largest = {s: max(size(r[1]) for r in before if r[3] == s) for s in sizes}
    for source, target in water_fill(sizes).items():
        assert abs(taken.get(source, 0) - target) <= max(0.03 * target, largest[source])


def test_encoding_equals_the_library(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = sorted((r.doc_id or -1, bytes(r.ids), r.n_tokens) for r in stages[5].collect())
    want = []
    for doc_id, text, *_ in rows(stages[4]):
        ids = library.encode(text, add_special_tokens=False).ids
        want.append((doc_id or -1, np.array(ids, dtype="<u4").tobytes(), len(ids)))
    assert got == sorted(want)


def test_run_and_empty_input(spark, empty):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 200
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "unused")
    assert docs.count() == 0
