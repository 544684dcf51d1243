import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ratingloom.llm import attribution, bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load_vocabulary(PATH)


def library_ids(library, texts):
    return [np.array(e.ids, dtype="<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]


PIECES = [
    "a", "B", "é", "1", "²", "Ⅷ", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", " ", " ", "'s", "'LL",
    "'ve", "<|endoftext|>", "<|end", "<", "aaaa", "中", "́", "😀", "_", "-", "...", "​", "﻿", "ſ", "　",
]


def test_random_texts_encode_as_the_library_does(library, vocabulary):
    rng = random.Random(4)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 16))) for _ in range(8000)]
    assert vocabulary.encode(texts) == library_ids(library, texts)


def test_every_character_class_is_cut_as_the_library_does(library, vocabulary):
    characters = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    texts = ["x" + c + "1" + c + c + " " + c + "?" + c + "\n" for c in characters]
    assert vocabulary.encode(texts) == library_ids(library, texts)


def test_decoding_matches_the_library_for_any_ids(library, vocabulary):
    rng = np.random.default_rng(3)
    for size in (0, 1, 3, 50):
        for _ in range(200):
            ids = rng.integers(0, 50257, size)
            assert vocabulary.decode(ids.astype("<u4").tobytes()) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_one_pair_in_overlapping_places(vocabulary, library):
    texts = ["a" * n for n in range(1, 40)] + ["=" * 70, "ababab" * 9, "\n" * 33]
    assert vocabulary.encode(texts) == library_ids(library, texts)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    sha = hashlib.sha256
    return len(ids), sha(np.array(ids, dtype="<u4").tobytes()).hexdigest(), sha(decoded.encode()).hexdigest()


@pytest.mark.parametrize("table", ["small", "odd", "empty"])
def test_digests_of_a_table(request, library, table):
    docs = request.getfixturevalue(table)
    got = [tuple(r) for r in bpe.digests(bpe.transcode(docs, PATH)).collect()]
    want = [(r.doc_id, *expected(library, r.text)) for r in docs.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("rule", attribution.RULES)
def test_sections_add_up_and_follow_the_rule(library, vocabulary, odd, rule):
    rows = attribution.section_tokens(odd, PATH, rule=rule).collect()
    texts = [(r.doc_id, r.text or "") for r in odd.collect()]
    total = sum(len(library.encode(t, add_special_tokens=False).ids) for _, t in texts)
    assert sum(r.n_tokens for r in rows) == total
    text = dict(texts)[8]
    mine = sorted((r.section, r.start, r.end, r.n_tokens, r.n_crossing) for r in rows if r.doc_id == 8)
    bounds, at = [], 0
    for line in text.splitlines(keepends=True):
        bounds.append((at, at + len(line)))
        at += len(line)
    assert [(m[1], m[2]) for m in mine] == bounds
    # Brute force over the library's offsets; the text is ASCII, so they are bytes, too.
    counts, crossing = [0] * len(bounds), [0] * len(bounds)
    for start, end in library.encode(text, add_special_tokens=False).offsets:
        touched = [k for k, (a, b) in enumerate(bounds) if start < b and end > a]
        held = [min(bounds[k][1], end) - max(bounds[k][0], start) for k in touched]
        chosen = {"first": touched[0], "last": touched[-1], "most": touched[held.index(max(held))]}[rule]
        counts[chosen] += 1
        crossing[chosen] += len(touched) > 1
    assert [(m[3], m[4]) for m in mine] == list(zip(counts, crossing))


def test_fields_are_encoded_together(spark, library):
    docs = spark.createDataFrame([(1, "Title here", "a\nb"), (2, None, "x"), (3, "", None)], "doc_id long, title string, body string")
    rows = attribution.section_tokens(docs, PATH, fields=("title", "body")).collect()
    found = {}
    for r in rows:
        found.setdefault(r.doc_id, []).append((r.field, r.section, r.start, r.end))
    assert sorted(found[1]) == [("body", 0, 11, 13), ("body", 1, 13, 14), ("title", 0, 0, 11)]
    whole = {1: "Title here\na\nb", 2: "\nx", 3: "\n"}
    for doc, text in whole.items():
        assert sum(r.n_tokens for r in rows if r.doc_id == doc) == len(library.encode(text, add_special_tokens=False).ids)


def test_wrong_rule_is_refused(small):
    with pytest.raises(ValueError):
        attribution.section_tokens(small, PATH, rule="middle")


def test_pieces_of_a_long_text_give_the_ids_of_the_whole(spark, monkeypatch):
    """Irregular white space, special tokens and other scripts on both sides of every cut."""
    monkeypatch.setattr(bpe, "BLOCK", 64)
    rng = random.Random(12)
    parts = ["word", "it's", "12", " ", "  ", "\n", "\t ", "漢字", "é", "🙂", "<|endoftext|>", "...", "\u00a0", "\x1c", "x "]
    texts = [" ".join(rng.choice(parts) for _ in range(400)) for _ in range(12)] + ["a" * 500, " " * 300, "b " * 200, ""]
    for text in texts:
        assert "".join(bpe.pieces(text, 64)) == text
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for r in bpe.transcode(docs, path).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(r.ids, dtype="<u4").tolist() == ids
        assert r.decoded == library.decode(ids, skip_special_tokens=False)
