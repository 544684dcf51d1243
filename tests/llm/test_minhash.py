import random

import numpy as np
import pytest

from ratingloom.llm import graph, minhash

LAYOUT = "doc_id long, text string"


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    out, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out


def brute_force(rows):
    """Sizes per row, and the component of every id, from all pairs."""
    sets = []
    for _, text in rows:
        w = words_of(text)
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set()))
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(rows[a][0]), root(rows[b][0])
                parent[max(x, y)] = min(x, y)
    return sorted(
        ((i, len(s), None if i is None else root(i), True if i is None else root(i) == i) for (i, _), s in zip(rows, sets)),
        key=str,
    )


def check(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in minhash.near_duplicates(df).collect()), key=str)
    assert got == brute_force(rows)


@pytest.mark.parametrize("table", ["small", "odd", "empty"])
def test_tables(request, table):
    check(request.getfixturevalue(table))


def test_chains_copies_and_near_misses(spark, monkeypatch):
    """Copies in hundreds, chains whose ends are not alike, pairs just under the limit, tiles of a few members."""
    monkeypatch.setattr(minhash, "TILE", 4)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, base = [], [rng.choice(vocabulary) for _ in range(80)]
    for step in range(40):
        base = base.copy()
        base[rng.randrange(80)] = rng.choice(vocabulary)
        rows.append(" ".join(base))
    rows += [rows[3].upper()] * 150
    rows += [" ".join(base[:k]) for k in range(1, 80, 6)]
    rows += [" ".join(rng.choice(vocabulary) for _ in range(60)) for _ in range(30)]
    order = list(range(len(rows)))
    rng.shuffle(order)
    check(spark.createDataFrame([(i, t) for i, t in zip(order, rows)], LAYOUT).repartition(6))


def test_one_id_with_two_texts_joins_both_groups(spark):
    first, second = (" ".join(f"{c}{i}" for i in range(50)) for c in "xy")
    check(spark.createDataFrame([(5, first), (2, second), (5, second), (9, first), (9, first)], LAYOUT))


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(60):
        common = rng.integers(0, 2**63, 300).astype(np.uint64)
        a, b = (np.unique(np.concatenate([common, rng.integers(0, 2**63, 75).astype(np.uint64)])) for _ in range(2))
        signed = minhash.signatures_of([a, b], 200)
        errors.append((signed[0] == signed[1]).mean() - 300 / 450)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_components_of_a_path_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(20, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (8, 3), (3, 8)]
    found = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    expected = {i: 20 for i in range(20, 61)} | {i: 100 for i in range(100, 140)} | {8: 3, 3: 3}
    assert {r.node: r.component for r in found} == expected and len(found) == len(expected)


def test_each_set_of_an_id_keeps_its_own_links(spark):
    """Near copies of both texts of one id, and one id and text in more rows than a tile has members."""
    rng = random.Random(9)
    first, second = ([rng.choice("abcdefgh") + str(i) for i in range(90)] for _ in range(2))
    near = [" ".join(w if i != 40 else "changed" for i, w in enumerate(t)) for t in (first, second)]
    first, second = " ".join(first), " ".join(second)
    check(spark.createDataFrame([(1, first), (1, second), (2, near[0]), (3, near[1])], LAYOUT))
    check(spark.createDataFrame([(7, first), (7, second), (4, near[1]), (9, near[0]), (7, ""), (7, None)], LAYOUT))


def test_one_row_repeated_beyond_a_tile(spark, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", 4)
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text)] * 60 + [(8, text + " tail"), (3, "w " + text), (6, "other words that are not linked")]
    check(spark.createDataFrame(rows, LAYOUT).repartition(4))


def test_large_disjoint_sets_do_not_agree():
    rng = np.random.default_rng(6)
    for size in (300, 1000, 3000, 20000):
        sets = [np.unique(rng.integers(0, 2**63, size).astype(np.uint64)) for _ in range(8)]
        codes = minhash.codes_of(minhash.signatures_of(sets, 200))
        agreeing = (codes[:, None] == codes[None]).sum(axis=2)
        assert agreeing[~np.eye(8, dtype=bool)].max() < 10


def test_components_of_byte_strings_and_of_nothing(spark):
    edges = [(b"b", b"a"), (b"c", b"b"), (b"z", b"y")]
    found = graph.components(spark.createDataFrame(edges, "a binary, b binary")).collect()
    assert {bytes(r.node): bytes(r.component) for r in found} == {b"a": b"a", b"b": b"a", b"c": b"a", b"y": b"y", b"z": b"y"}
    assert graph.components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0
