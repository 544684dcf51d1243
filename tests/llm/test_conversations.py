import hashlib
import heapq
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ratingloom.llm import conversations

LAYOUT = "conv_id long, turn long, role string, text string, kind string, gaps string, digest string, mark string"
WORD = re.compile(r"[^\x20\x09-\x0D]")


def fault(role, text, seen):
    if not WORD.search(text):
        return "blank"
    if (role, text) in seen:
        return "duplicate"
    return "sound" if WORD.findall(text)[-1] in ".!?" else "truncated"


def cheapest(turns):
    """Cost and letters by Dijkstra's search over whole output sequences; ``turns`` are (role, fault)."""
    queue = [(0, "", 0, "")]
    done = set()
    while True:
        cost, letters, i, roles = heapq.heappop(queue)
        # What matters of the roles so far is how they may go on.
        state = roles if len(roles) < 2 else roles[-1] + str(roles[0] == "s")
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(turns) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, letters
        steps = [("I", r, 5, i) for r in "ua"]
        if i < len(turns):
            role, kind = turns[i]
            steps.append(("D", "", 2, i + 1))
            if kind in ("sound", "truncated"):
                more = 5 if kind == "truncated" else 0
                steps += [("K", role[:1], more, i + 1)] + [("R", r, 1 + more, i + 1) for r in "ua"]
        for letter, r, price, following in steps:
            if not r and letter != "D":
                continue
            if re.fullmatch("s?(ua)*u?", roles + r):
                heapq.heappush(queue, (cost + price, letters + letter, following, roles + r))


def brute_force(rows, ids):
    out = []
    for conv_id in ids:
        turns = sorted((r for r in rows if r[0] == conv_id), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, faults = set(), []
        for _, _, role, text in turns:
            faults.append(fault(role, text, seen))
            seen.add((role, text))
        cost, letters = cheapest([(r[2], f) for r, f in zip(turns, faults)])
        lines, state, place = [], "", 0
        for letter in letters:
            role = "assistant" if state == "u" else "user"
            if letter == "I":
                lines.append(role + ":")
                state = role[0]
                continue
            _, _, own, text = turns[place]
            place += 1
            if letter != "D":
                role = own if letter == "K" else role
                lines.append(f"{role}:{text}")
                state = role[0]
        numbers = [r[1] for r in turns if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv_id, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, letters, digest))
    return sorted(out, key=repr)


def damaged(rows):
    out = []
    for conv_id, turn, role, text in rows:
        conv, number, role, text = (" " if x is None else x for x in (conv_id, turn, role, text))
        lot = zlib.crc32(f"{conv}:{number}".encode()) % 20
        if lot == 0:
            continue
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        out += [(conv_id, turn, "user" if lot == 4 else role, text)] * (2 if lot == 3 else 1)
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], LAYOUT).repartition(5)


MARKS = st.lists(st.sampled_from([r + f for r in "sua?" for f in "0123"]), max_size=9)


@settings(max_examples=400, deadline=None)
@given(MARKS, st.integers(1, 4))
def test_search_is_cheapest_and_pieces_agree(turns, piece):
    kinds = ["sound", "blank", "duplicate", "truncated"]
    expected = cheapest([(t[0].replace("?", "x"), kinds[int(t[1])]) for t in turns])
    assert conversations.cheapest_edits(turns) == expected
    assert conversations.cheapest_edits(turns, whole=0, piece=piece) == expected


def test_long_conversation_in_time():
    rng = random.Random(3)
    turns = ["s0"] + [rng.choice("uuaa?s") + rng.choice("0000000123") for _ in range(5000)]
    cost, letters = conversations.cheapest_edits(turns)
    assert sum(letters.count(x) for x in "DKR") == len(turns)
    assert conversations.cheapest_edits(turns, piece=31) == (cost, letters)


def odd_rows():
    rng = random.Random(8)
    rows = []
    for conv_id in range(60):
        for turn in range(rng.randrange(1, 8)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice([f"Yes {conv_id}.", "No!\n", "Und so weiter", "Çà 漢字🙂?", "", " \t\n", None, "x." * 50])
            rows.append((conv_id, turn * rng.choice([1, 1, 2]), role, text))
    rows += [(None, 0, "user", "A."), (None, 1, "assistant", "B."), (None, None, None, None)]
    rows += [(70, None, "user", "A."), (70, 3, "assistant", "B."), (70, 3, "assistant", "B."), (70, -2, "system", "S.")]
    rows += [(71, 0, "user", "word " * 20000 + "."), (71, 1, "assistant", "Fine.")]
    return rows


def test_repair_of_damaged_rows_matches_brute_force(spark):
    rows = odd_rows()
    conv = table(spark, rows)
    assert sorted(map(repr, map(tuple, conversations.damage(conv).collect()))) == sorted(map(repr, damaged(rows)))
    got = sorted((tuple(r) for r in conversations.repair(conversations.damage(conv), conv).collect()), key=repr)
    assert got == brute_force(damaged(rows), {r[0] for r in rows})


def test_turns_all_dropped_and_empty_table(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    conv = table(spark, [(lost, 0, "user", "Hello.")])
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in conversations.repair(conversations.damage(conv), conv).collect()] == [
        (lost, 0, 0, 0, 0, 0, 0, "", empty)
    ]
    nothing = conv.limit(0)
    assert conversations.repair(nothing, nothing).count() == 0
    assert conversations.repaired(nothing).count() == 0


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "assistant", "A."), (1, 2, "assistant", "A."), (1, 3, "assistant", "B.")]
    got = [tuple(r) for r in conversations.repaired(table(spark, rows)).orderBy("position").collect()]
    assert got == [(1, 0, "system", "S."), (1, 1, "user", "A."), (1, 2, "assistant", "B.")]


@pytest.mark.parametrize("name", ["sf0.001"])
def test_repaired_rows_give_the_digest(spark, name):
    conv = conversations.damage(spark.read.parquet(f"/root/testdata/{name}/conversations.parquet"))
    lines = {}
    for r in conversations.repaired(conv).collect():
        lines.setdefault(r.conv_id, {})[r.position] = f"{r.role}:{r.text}"
    for r in conversations.repair(conv).collect():
        text = "\n".join(lines.get(r.conv_id, {}).get(i) for i in range(len(lines.get(r.conv_id, {}))))
        assert hashlib.sha256(text.encode()).hexdigest() == r.repaired_sha256


def test_driver_table_matches_brute_force(spark, folder):
    conv = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in conv.collect()]
    got = sorted((tuple(r) for r in conversations.repair(conversations.damage(conv), conv).collect()), key=repr)
    assert got == brute_force(damaged(rows), {r[0] for r in rows})
