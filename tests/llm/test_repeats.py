import hashlib
import random

import numpy as np
import pandas as pd
import pytest

from ratingloom.llm import repeats

LAYOUT = "doc_id long, text string"


def brute_force(rows):
    """Digest rows; equal (id, text) rows are one document, null ids come last."""
    documents = sorted({(2**63 if i is None else i, t or "", i) for i, t in rows}, key=lambda d: d[:2])
    seen, result = set(), {}
    for _, text, doc in documents:
        data = text.encode()
        covered = bytearray(len(data))
        for s in range(len(data) - 99):
            window = data[s : s + 100]
            if window in seen:
                covered[s : s + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(x for x, c in zip(data, covered) if not c)
        runs = sum(1 for i, c in enumerate(covered) if c and (i == 0 or not covered[i - 1]))
        result[doc, text] = (doc, len(data), sum(covered), runs, hashlib.sha256(kept).hexdigest())
    return sorted((result[i, t or ""] for i, t in rows), key=str)


def check(df, **options):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in repeats.digests(repeats.remove_repeats(df, **options)).collect()), key=str)
    assert got == brute_force(rows)


@pytest.mark.parametrize("table", ["small", "odd", "empty"])
def test_tables(request, table):
    check(request.getfixturevalue(table))


@pytest.mark.parametrize("hot", [2, 10, 20_000])
def test_passages_periods_and_borders(spark, hot, monkeypatch):
    monkeypatch.setattr(repeats, "_REFINED", 4000)
    rng = random.Random(8)

    def prose(n):
        return "".join(rng.choice("abcdefghij élü ") for _ in range(n))

    passage, line = prose(180), prose(40) + "\n"
    rows = []
    for i in range(120):
        kind = i % 6
        if kind == 0:
            text = prose(rng.randint(0, 90)) + passage + prose(rng.randint(0, 90))
        elif kind == 1:
            text = prose(30) + passage[rng.randint(0, 90) :] + prose(10)
        elif kind == 2:
            text = line * rng.randint(1, 9) + prose(50)
        elif kind == 3:
            text = rng.choice("xy") * rng.randint(90, 260) + prose(20)
        elif kind == 4:
            text = prose(99 + i % 3)
        else:
            text = rng.choice(rows)[1] if rows else ""
        rows.append((i * 3 % 120, text))
    check(spark.createDataFrame(rows, LAYOUT).repartition(7), hot=hot)


def test_exact_fallback_agrees_with_refinement():
    rng = random.Random(1)
    base = bytes(rng.randrange(4) for _ in range(400))
    texts = [base[a : a + rng.randint(100, 170)] for a in range(0, 230, 11)]
    windows = np.array([len(t) - 99 for t in texts])
    stretch, offset, _ = repeats.refine(texts, windows)
    other = repeats._exact(texts, windows)
    assert list(zip(stretch, offset)) == list(zip(*other))


def test_bucket_far_over_a_block_is_refined_in_parts(monkeypatch):
    """Many rows of one divided anchor, more than a block holds: only firsts stay, all others are reported."""
    monkeypatch.setattr(repeats, "_REFINED", 2000)
    window, other = b"w" * 100, b"v" * 100
    rows = [(7, i, 0, i % 5, 1, other if i % 50 == 3 else window) for i in range(2000)]
    rows += [(9, i, 0, 0, 11, bytes(range(110))) for i in range(40)]
    table = pd.DataFrame(rows, columns=["anchor", "id", "text_key", "first", "n", "text"])
    held = []
    refined = repeats._refined

    def noted(part):
        held.append(len(part))
        return refined(part)

    monkeypatch.setattr(repeats, "_refined", noted)
    frames = (table[i : i + 64] for i in range(0, len(table), 64))
    found = pd.concat(list(repeats._refine_sorted(frames)))
    got = {tuple(r) for r in found[["id", "start", "end"]].itertuples(index=False)}
    assert got == {(i, i % 5, i % 5 + 100) for i in range(2000) if i not in (0, 3)} | {(i, 0, 110) for i in range(1, 40)}
    assert max(held) < 120


def test_null_id_and_null_text_rows(spark):
    passage = "".join(f"{i} " for i in range(80))
    check(spark.createDataFrame([(None, None)] * 30 + [(None, passage)] * 3 + [(1, None)], LAYOUT).repartition(3))
