"""Repair of conversation structure by iterative-deepening A*.

Every turn is reduced to one character: the initial of its role and its first
fault. The characters of a conversation, in order of its turns, are searched
depth first in the ASCII order of the edits, under a cost bound that rises to
the least cost left out, with a table of states that failed. The first path that
leaves an accepted sequence of roles is the cheapest and, among the cheapest,
the least one. Texts never meet in one place: the edits are applied while the
sorted turns stream by.
"""

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

# What separates words, what ends a sentence, the initials of the roles.
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
_ENDS = ".!?"
_INITIALS = "sua"
_LEGAL = {"su", "ua", "au"}
# Fixed costs of the edits, and of a truncated turn that stays.
DELETE, INSERT, KEEP, REROLE, TRUNCATED = 2, 5, 0, 1, 5

# First faults of a turn.
_SOUND, _BLANK, _DUPLICATE, _CUT = range(4)
# What the repaired turns so far end with.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_FOLLOWS = {(_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER, (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER}
_ACCEPTED = (_START, _ASSISTANT)

# Conversations beyond WHOLE turns are searched in pieces of PIECE turns, as each
# higher bound visits all turns again; the answer is the same.
WHOLE = 512
PIECE = 48


def _next_role(state: int) -> int:
    """The only role that an inserted or renamed turn can take."""
    return _ASSISTANT if state == _USER else _USER


def _edits(state: int, turn: str) -> list[tuple[str, int, int]]:
    """Edits of a turn in ASCII order: letter, cost, state after it."""
    initial, fault = turn[0], int(turn[1])
    out = [("D", DELETE, state)]
    if fault in (_SOUND, _CUT):
        extra = TRUNCATED if fault == _CUT else 0
        if (state, initial) in _FOLLOWS:
            out.append(("K", KEEP + extra, _FOLLOWS[state, initial]))
        out.append(("R", REROLE + extra, _next_role(state)))
    return out


def _estimates(turns: tuple[str, ...], goals: tuple[int, ...], tail: bool) -> list[list[float]]:
    """Lower bounds of what is still to pay, by place and by whether the assistant is due.

    The costs of an abstraction that forgets where system turns may stand: all
    states in which the user is due are one, and a system turn can be kept there.
    """
    due = {goal == _USER for goal in goals}
    ends = [0 if x in due else math.inf for x in (False, True)]
    out = [[min(ends[x], INSERT + ends[not x]) if tail else ends[x] for x in (False, True)]]
    for turn in reversed(turns):
        best = []
        for state in (_ASSISTANT, _USER):
            costs = [cost + out[-1][after == _USER] for _, cost, after in _edits(state, turn)]
            if state == _ASSISTANT and turn[0] == "s" and int(turn[1]) in (_SOUND, _CUT):
                costs.append(KEEP + (TRUNCATED if int(turn[1]) == _CUT else 0) + out[-1][False])
            best.append(min(costs))
        out.append([min(best[x], INSERT + best[not x]) for x in (False, True)])
    return out[::-1]


def _deepen(turns: tuple[str, ...], start: int, goals: tuple[int, ...], tail: bool) -> tuple[int, str] | None:
    """Cost and letters of the cheapest edits from state ``start`` to one of ``goals``, or null.

    ``tail`` allows insertions behind the last turn. Iterative deepening: the
    bound grows by the least amount by which any path exceeded it.
    """
    ahead = _estimates(turns, goals, tail)
    # Deleting every turn and inserting a pair reaches every state that can be reached.
    most = DELETE * len(turns) + 2 * INSERT
    bound = ahead[0][start == _USER]

    def steps(i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """Edits in ASCII order: letter, cost, state and place after it."""
        insertion = ("I", INSERT, _next_role(state), i)
        if i < len(turns):
            (letter, cost, after), *others = _edits(state, turns[i])
            yield letter, cost, after, i + 1
            yield insertion
            yield from ((letter, cost, after, i + 1) for letter, cost, after in others)
        elif tail:
            yield insertion

    while bound <= most:
        # The largest remaining bound with which a state failed.
        failed: dict[tuple[int, int], int] = {}
        excess = most + 1 - bound
        if not turns and start in goals:
            return bound, ""
        path: list[str] = []
        open_states = [(0, start, bound, steps(0, start))]
        while open_states:
            i, state, left, rest = open_states[-1]
            for letter, cost, after, following in rest:
                missing = cost + ahead[following][after == _USER] - left
                if missing > 0:
                    excess = min(excess, missing)
                elif following == len(turns) and after in goals:
                    return bound, "".join(path) + letter
                elif failed.get((following, after), -1) < left - cost:
                    path.append(letter)
                    open_states.append((following, after, left - cost, steps(following, after)))
                    break
            else:
                failed[i, state] = left
                open_states.pop()
                if path:
                    path.pop()
        bound += excess
    return None


@lru_cache(maxsize=4096)
def _search_piece(turns: tuple[str, ...], start: int, goals: tuple[int, ...], tail: bool) -> tuple[int, str] | None:
    if goals not in ((_START,), (_SYSTEM,)):
        return _deepen(turns, start, goals, tail)
    # Few ways stay before the first user turn: delete all, or all but one system turn, late rather than early.
    if start == goals[0]:
        return DELETE * len(turns), "D" * len(turns)
    if start != _START:
        return None
    kept = [
        (cost + DELETE * (len(turns) - 1), "D" * i + "K" + "D" * (len(turns) - 1 - i))
        for i, turn in enumerate(turns)
        for letter, cost, after in _edits(_START, turn)
        if letter == "K" and after == _SYSTEM
    ]
    return min(kept, default=None)


def cheapest_edits(turns: list[str], whole: int = WHOLE, piece: int = PIECE) -> tuple[int, str]:
    """Least cost and ASCII-least letters that repair ``turns`` (initial and fault each).

    A long conversation is cut into pieces, each searched from every state to
    every state, and joined from the end. Letters of a piece end with those of a
    turn, so that none is the beginning of another of the same turns, and the
    least of all is the least of the first piece followed by the least of the rest.
    """
    size = max(len(turns), 1) if len(turns) <= whole else piece
    pieces = [tuple(turns[i : i + size]) for i in range(0, len(turns), size)] or [()]
    # By state at the start of a piece: cost, letters of the piece, state behind it.
    chosen: list[dict[int, tuple[int, str, int]]] = []
    costs: dict[int, int] = {}
    for number in range(len(pieces) - 1, -1, -1):
        starts = (_START,) if number == 0 else (_START, _SYSTEM, _USER, _ASSISTANT)
        step = {}
        for start in starts:
            if number == len(pieces) - 1:
                found = _search_piece(pieces[number], start, _ACCEPTED, True)
                ways = [(*found, _START)] if found else []
            else:
                ways = []
                for goal in costs:
                    found = _search_piece(pieces[number], start, (goal,), False)
                    if found:
                        ways.append((found[0] + costs[goal], found[1], goal))
            if ways:
                step[start] = min(ways)
        costs = {start: way[0] for start, way in step.items()}
        chosen.append(step)
    letters, state = [], _START
    for step in reversed(chosen):
        _, part, state = step[state]
        letters.append(part)
    return costs[_START], "".join(letters)


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with planted faults, drawn by the CRC of ``conv_id:turn``.

    Of 20 remainders 0 drops the turn, 1 empties its text, 2 removes the ends of
    its sentences, 3 repeats it and 4 makes it the user's. A null counts as one space.
    """
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    lot = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text = F.when(lot == 1, "").when(lot == 2, F.regexp_replace(shown("text"), f"[{_ENDS}]", "")).otherwise(shown("text"))
    return (
        conversations.filter(lot != 0)
        .select(
            "conv_id", "turn", F.when(lot == 4, "user").otherwise(shown("role")).alias("role"), text.alias("text"),
            F.explode(F.sequence(F.lit(1), F.when(lot == 3, 2).otherwise(1))).alias("_copy"),
        )
        .drop("_copy")
    )


def _turns(conversations: DataFrame) -> DataFrame:
    """Turns with the digest that orders turns of the same number and finds repeated ones."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return conversations.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), F.unhex(F.sha2(named.cast("binary"), 256)).alias("digest")
    )


_REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_REPORT_DDL = "conv_id long, " + ", ".join(f"{name} long" for name in _REPORT) + ", audit string"
_REPORT_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), *((name, pa.int64()) for name in _REPORT), ("audit", pa.string())]
)


def _report(turns: list[str], numbers: tuple[int | None, int | None, int]) -> tuple:
    first, last, distinct = numbers
    faults = [turn[1] for turn in turns]
    cost, audit = cheapest_edits(turns)
    return (
        0 if first is None else last - first + 1 - distinct,
        *(faults.count(str(fault)) for fault in (_BLANK, _DUPLICATE, _CUT)),
        sum(a[0] + b[0] not in _LEGAL for a, b in zip(turns, turns[1:])),
        cost,
        audit,
    )


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One report per conversation of sorted turns; holds two characters a turn of one conversation."""
    opened, current = False, None
    turns: list[str] = []
    first = last = None
    distinct = 0
    out: list[tuple] = []
    for batch in batches:
        for conv_id, turn, mark in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "mark"))):
            if not opened or conv_id != current:
                if opened:
                    out.append((current, *_report(turns, (first, last, distinct))))
                opened, current, turns, first, last, distinct = True, conv_id, [], None, None, 0
            # A row without mark only names its conversation.
            if mark is not None:
                turns.append(mark)
                if turn is not None:
                    distinct += turn != last
                    first = turn if first is None else first
                    last = turn
        if out:
            yield _batch(out, _REPORT_SCHEMA)
            out = []
    if opened:
        yield _batch([(current, *_report(turns, (first, last, distinct)))], _REPORT_SCHEMA)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def reports(conversations: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``conv_id``, counts of faults, ``cost`` and ``audit`` of every conversation; see ``repair``."""
    turns = _turns(conversations)
    stripped = F.rtrim(F.col("text"), F.lit(_SPACE))
    again = F.row_number().over(Window.partitionBy("conv_id", "digest").orderBy("turn")) > 1
    fault = (
        F.when(F.col("empty"), _BLANK)
        .when(F.col("again"), _DUPLICATE)
        .when(F.col("ended"), _SOUND)
        .otherwise(_CUT)
    )
    initial = F.substring("role", 1, 1)
    marked = (
        turns.select(
            "conv_id", "turn", "role", "digest", (stripped == "").alias("empty"),
            F.substring(stripped, -1, 1).isin(*_ENDS).alias("ended"),
        )
        .withColumn("again", again)
        .select(
            "conv_id", "turn", "role", "digest", "again",
            F.concat(F.when(initial.isin(*_INITIALS), initial).otherwise("?"), fault.cast("string")).alias("mark"),
        )
    )
    if ids is not None:
        named = ids.select("conv_id").distinct()
        for name, kind in marked.dtypes[1:]:
            named = named.withColumn(name, F.lit(None).cast(kind))
        marked = marked.unionByName(named)
    return (
        marked.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "digest", "again")
        .select("conv_id", "turn", "mark")
        .mapInArrow(_reports, _REPORT_DDL)
    )


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, tuple]]:
    """Reports and repaired turns in order: ``(True, report)`` opens a conversation, ``(False, (role, text))`` adds a turn."""
    names = {_USER: "user", _ASSISTANT: "assistant"}
    letters, place, state = "", 0, _START

    def insertions():
        nonlocal place, state
        while place < len(letters) and letters[place] == "I":
            state = _next_role(state)
            place += 1
            yield False, (names[state], "")

    for batch in batches:
        reports_ = [batch.column(c) for c in ("conv_id", *_REPORT, "audit")]
        roles, texts = batch.column("role"), batch.column("text")
        for i in range(len(batch)):
            if roles[i].as_py() is None:
                yield from insertions()
                report = tuple(column[i].as_py() for column in reports_)
                letters, place, state = report[-1], 0, _START
                yield True, report
                continue
            yield from insertions()
            letter, role = letters[place], roles[i].as_py()
            place += 1
            if letter == "D":
                continue
            if letter == "R":
                state = _next_role(state)
                role = names[state]
            else:
                state = _FOLLOWS[state, role[0]]
            yield False, (role, texts[i].as_py())
    yield from insertions()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _REPORT_SCHEMA.append(pa.field("repaired_sha256", pa.string()))
    report, digest, begun, out = None, hashlib.sha256(), False, []
    for opens, item in _repaired(batches):
        if opens:
            if report is not None:
                out.append((*report, digest.hexdigest()))
                if len(out) == 1000:
                    yield _batch(out, schema)
                    out = []
            report, digest, begun = item, hashlib.sha256(), False
        else:
            digest.update(f"{chr(10) if begun else ''}{item[0]}:{item[1]}".encode())
            begun = True
    if report is not None:
        yield _batch([*out, (*report, digest.hexdigest())], schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    conv_id, position, out, held = None, 0, [], 0
    for opens, item in _repaired(batches):
        if opens:
            conv_id, position = item[0], 0
            continue
        out.append((conv_id, position, *item))
        position += 1
        held += len(item[1])
        if len(out) == 10_000 or held > 1 << 22:
            yield _batch(out, schema)
            out, held = [], 0
    if out:
        yield _batch(out, schema)


def _stream(conversations: DataFrame, found: DataFrame, kernel, layout: str) -> DataFrame:
    """Every conversation's report followed by its turns in order, passed through ``kernel``."""
    turns = _turns(conversations).withColumn("kind", F.lit(1))
    both = turns.unionByName(found.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    return (
        both.repartition("conv_id")
        .sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
        .select("role", "text", "conv_id", *_REPORT, "audit")
        .mapInArrow(kernel, layout)
    )


def repair(conversations: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Faults and cheapest repair of every conversation of ``conversations(conv_id, turn, role, text)``.

    Turns are taken by ``turn``, nulls first; turns of the same number by role
    and digest. The first fault of a turn counts: ``blank`` (no word),
    ``duplicate`` (role and text seen earlier), ``truncated`` (does not end with
    ``.``, ``!`` or ``?``). ``gaps`` counts missing numbers, ``illegal`` adjacent
    roles that may not follow each other. Edits are Keep (0), Rerole to user or
    assistant (1), Delete (2, required for blank and duplicate turns) and Insert
    of an empty turn (5); a truncated turn that stays costs 5 more. ``audit``
    holds the initials of the cheapest edits that leave nothing, or an optional
    system turn and then pairs of user and assistant; among equals the ASCII-least.
    ``repaired_sha256`` is the digest of the repaired ``role:text`` lines.

    A null role or text counts as one space, a null ``conv_id`` is a conversation
    of its own, a repeated row is a duplicate turn, further columns are ignored.
    Conversations that only ``ids`` names have zeros, an empty audit and the
    digest of nothing; an empty table gives no row. A task holds two characters
    per turn of one conversation, and never its texts.
    """
    return _stream(conversations, reports(conversations, ids), _digests, _REPORT_DDL + ", repaired_sha256 string")


def repaired(conversations: DataFrame) -> DataFrame:
    """The repaired turns: ``conv_id, position, role, text``; conversations left empty have none."""
    return _stream(
        conversations, reports(conversations), _rows, "conv_id long, position long, role string, text string"
    )
