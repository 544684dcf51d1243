import math
import random
import re
from collections import Counter

import pytest

from ratingloom.llm import quality
from ratingloom.session import durable


def measured(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


@pytest.mark.parametrize("table", ["small", "odd", "empty"])
def test_measures_equal_brute_force(request, table):
    docs = request.getfixturevalue(table)
    rows = quality.quality_rules(docs).collect()
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows), key=str)
    assert got == sorted(((r.doc_id, *measured(r.text)) for r in docs.collect()), key=str)
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


MEASURES = "lang string, source string, word_chars long, n_symbols long, n_words long, n_lines long, n_dup_lines long, n_repeat_words long"


def test_sketches_merge_and_their_quartiles_are_near(spark):
    values = [(i * 7919) % 10_000 for i in range(4000)]
    rows = [("en" if i % 2 else "de", "s", 10_000, v, 100, 1, 0, 0) for i, v in enumerate(values)]
    sketch = quality.sketches(spark.createDataFrame(rows, MEASURES))
    assert {r["n"] for r in sketch.filter("rule = 'symbol_share'").groupBy("lang").sum("n").toDF("lang", "n").collect()} == {2000}
    fence = {r.rule: r.all_fence for r in quality._fences(sketch, [], 1, "all").collect()}["symbol_share"]
    share = sorted(quality.MILLION * (2 * v + 1) // 20_001 for v in values)
    assert math.isclose(fence, share[2999] * share[2999] / share[999], rel_tol=0.03)


def test_fences_of_groups_differ_and_lean_on_wider_ones(spark):
    rows = [("en", "code", 80 + i % 40) for i in range(400)] + [("en", "prose", 10 + i % 5) for i in range(400)]
    rows += [("en", "tiny", 900)] + [(None, None, 20)] * 3
    table = spark.createDataFrame([(lang, source, 1000, v, 100, 9, 0, 0) for lang, source, v in rows], MEASURES)
    found = {(r.lang, r.source): r for r in quality.thresholds(quality.sketches(table)).filter("rule = 'symbol_share'").collect()}
    code, prose, tiny = (found["en", source] for source in ("code", "prose", "tiny"))
    assert code.fence > 3 * prose.fence and (None, None) in found
    # One document says little: the fence is near the language's, not the document's own.
    near, own = (abs(math.log(tiny.fence / x)) for x in (tiny.lang_fence, tiny.group_fence))
    assert near < own / 20


def test_weight_of_a_group_grows_without_a_jump(spark):
    fences = []
    for n in (45, 49, 50, 51, 55):
        rows = [("en", "a", 5 + i % 5) for i in range(500)] + [("en", "b", 100 + i % 9) for i in range(n)]
        table = spark.createDataFrame([(lang, source, 1000, v, 100, 9, 0, 0) for lang, source, v in rows], MEASURES)
        fences.append(quality.thresholds(quality.sketches(table)).filter("rule = 'symbol_share' and source = 'b'").first().fence)
    assert all(abs(b - a) < 0.1 * a for a, b in zip(fences, fences[1:]))


def test_the_fence_of_the_source_decides(spark):
    """The same text with some symbols stays where such are usual, and goes where they are not."""
    rng = random.Random(3)

    def text(symbols):
        longest = rng.randrange(4, 12)
        words = ["".join(rng.choices("abcdefgh", k=rng.randrange(1, longest))) for _ in range(rng.randrange(100, 200))]
        return " ".join(w + "#" * (rng.random() < symbols) for w in words)

    rows = [(i, text(0.2), "en", "code") for i in range(300)] + [(1000 + i, text(0), "en", "prose") for i in range(300)]
    some = text(0.2)
    rows += [(5000, some, "en", "code"), (5001, some, "en", "prose")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.quality_rules(docs).filter("doc_id >= 5000").collect()}
    assert kept == {5000: True, 5001: False}


def test_fences_of_every_rule_differ_between_groups_of_the_corpus(small):
    docs = small.sparkSession.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = quality.thresholds(quality.sketches(durable(quality.measure(docs), "measures"))).collect()
    for rule in quality.RULES:
        fences = [r.fence for r in rows if r.rule == rule.name]
        assert len(set(fences)) > 0.9 * len(fences)


def test_junk_goes_and_clean_documents_stay(small):
    labels = small.sparkSession.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = small.sparkSession.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = quality.quality_rules(docs).join(labels, "doc_id").filter("not base_failed").collect()
    clean = [r.kept for r in rows if r.quality == 1 and r.toxic == 0]
    junk = [r.kept for r in rows if r.quality == 0]
    assert sum(clean) >= 0.995 * len(clean)
    assert sum(junk) <= 0.2 * len(junk)
