"""Token counts per field and section, attributed by offsets.

A document (its fields, joined by a line feed) is encoded once as a whole. Its
tokens and its sections are both sorted intervals of the text, so their join is
a binary search. Counting sections alone would give other tokens at their edges.

A section is a line of a field with its line feed. A token that crosses a
boundary goes to one section by an explicit rule: ``first`` (where it starts),
``last`` (where it ends), or ``most`` (most of its bytes, the first of equals).
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.bpe import blocks, load_vocabulary

RULES = ("first", "last", "most")
# Between two fields; counted with the section that ends there.
FIELD_BREAK = "\n"


def _sections(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start byte and document of every section; an empty document has one empty section."""
    lines = np.flatnonzero(data == 10) + 1
    # A line feed that ends a document opens no section.
    doc = np.searchsorted(starts, lines, side="right") - 1
    inside = lines < ends[np.minimum(doc, len(ends) - 1)] if len(lines) else np.zeros(0, dtype=bool)
    at = np.concatenate((starts, lines[inside]))
    owner = np.concatenate((np.arange(len(starts)), doc[inside]))
    order = np.lexsort((at, owner))
    return at[order], owner[order]


def attribute_block(texts: list[str], ids: list[bytes], token_lengths: np.ndarray, rule: str) -> dict[str, np.ndarray]:
    """Sections of all texts with token counts: ``doc`` (position), ``section``, ``start``, ``end``, counts."""
    encoded = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(encoded), dtype=np.uint8)
    ends = np.cumsum([len(e) for e in encoded])
    starts = ends - np.array([len(e) for e in encoded])
    # Token ends run on from document to document, since each text is the sum of its tokens.
    token_end = np.cumsum(token_lengths[np.frombuffer(b"".join(ids), dtype="<u4")])
    token_start = np.concatenate(([0], token_end[:-1])) if len(token_end) else token_end

    at, owner = _sections(data, starts, ends)
    until = np.concatenate((at[1:], [len(data)]))
    first = np.searchsorted(at, token_start, side="right") - 1
    last = np.searchsorted(at, token_end - 1, side="right") - 1
    crossing = first != last
    chosen = first if rule == "first" else last.copy()
    if rule == "most":
        chosen = first.copy()
        for i in np.flatnonzero(crossing):
            parts = range(first[i], last[i] + 1)
            held = [min(until[p], token_end[i]) - max(at[p], token_start[i]) for p in parts]
            chosen[i] = parts[int(np.argmax(held))]
    # Character positions: bytes that begin a character, counted within the document.
    characters = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    number = np.arange(len(at)) - np.searchsorted(owner, owner, side="left")
    return {
        "doc": owner,
        "section": number,
        "start": characters[at] - characters[starts[owner]],
        "end": characters[until] - characters[starts[owner]],
        "n_tokens": np.bincount(chosen, minlength=len(at)),
        "n_crossing": np.bincount(chosen[crossing], minlength=len(at)),
    }


def section_tokens(
    docs: DataFrame, vocabulary_path: str, fields: tuple[str, ...] = ("text",), rule: str = "first"
) -> DataFrame:
    """Token counts per section: ``doc_id, field, section, start, end, n_tokens, n_crossing``.

    ``section`` numbers the lines of a field from 0; ``start`` and ``end`` are
    code points of the whole document, ``n_crossing`` counts the section's
    tokens that also cover another section. The counts of a document add up to
    its tokens. A null field counts as empty; an empty field has one section,
    without tokens but for those of its field break. Rows that repeat a document
    or have no id are counted like any other; further columns are ignored; an
    empty table gives no rows.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    vocabulary = load_vocabulary(vocabulary_path)
    lengths = np.array([len(b) for b in vocabulary.token_bytes], dtype=np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, lengths))
    names = list(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, lengths = shared.value
        for part, texts in blocks(batches):
            found = attribute_block(texts, vocabulary.encode(texts), lengths, rule)
            if len(names) == 1:
                field, section = np.zeros(len(found["doc"]), dtype=np.int64), found["section"]
            else:
                # Sections of a field: its line feeds plus one, the field break included.
                lines = np.stack([part.column(1 + i).to_numpy(zero_copy_only=False) for i in range(len(names))], axis=1)
                opened = np.cumsum(lines, axis=1)
                whole = opened[found["doc"]]
                field = (found["section"][:, None] >= whole[:, :-1]).sum(axis=1)
                before = np.concatenate((np.zeros((len(opened), 1), dtype=opened.dtype), opened), axis=1)
                section = found["section"] - before[found["doc"], field]
            columns = [
                part.column(0).take(pa.array(found["doc"])),
                pa.array(names).take(pa.array(field)),
                pa.array(section.astype(np.int32)),
                *(pa.array(found[c].astype(np.int64)) for c in ("start", "end", "n_tokens", "n_crossing")),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, names=["doc_id", "field", "section", "start", "end", "n_tokens", "n_crossing"]
            )

    texts = [F.coalesce(F.col(f"`{f}`"), F.lit("")) for f in names]
    counts = [
        (F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) + 1).cast("long").alias(f"_lines{i}")
        for i, t in enumerate(texts)
    ]
    whole = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *(counts if len(names) > 1 else []),
        F.concat_ws(FIELD_BREAK, *texts).alias("_whole"),
    )
    return whole.mapInArrow(
        run, "doc_id long, field string, section int, start long, end long, n_tokens long, n_crossing long"
    )
