"""Language identification by a linear-chain conditional random field over words.

Each word of a text is labelled with a language; neighbouring words are tied by
learned transitions, so a text may switch languages. Features of a word are its
affixes, its character n-grams and, as a lexicon, the word itself, all hashed
into one weight table. Training maximises the conditional likelihood by
forward-backward and AdaGrad on a bounded sample; since a document has one
label, training sequences switch languages by stringing segments of documents of
different languages together. Labelling is forward-backward again, over all
documents of a block at once; a document takes the language with the largest
mean posterior.
"""

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.bpe import blocks

WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
# Documents per language that training may see; whole texts are taken, and by hash about as many as this.
SAMPLE = 250
TABLE = 1 << 17
SEGMENT = 24
SEQUENCE = 240
EPOCHS = 12
RATE = 0.4
PENALTY = 1e-6
# Text labelled at once, in characters.
BLOCK = 1 << 21
# Words of a piece: longer texts are cut into pieces that run side by side, so that the number
# of steps does not grow with the longest text. And distinct words whose features are held at once.
PIECE = 256
WORDS = 1 << 14


def words_of(text: str) -> list[str]:
    """Lower-case runs of letters."""
    found = WORD.findall(text.lower())
    # The pattern also takes numerals that are no decimal digits.
    return found if text.isascii() else [w for w in found if any(map(str.isalpha, w))]


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words, and the word that each belongs to.

    With a space on both sides of a word, pairs that hold a space are affixes of
    one letter, triples affixes of two, and quadruples affixes of three.
    """
    text = " " + " ".join(words) + " "
    c = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    space = c == 32
    owner = np.cumsum(space) - 1
    parts, owners = [], []

    def add(hashed: np.ndarray, at: np.ndarray, kind: int) -> None:
        h = hashed[at] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(kind)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        parts.append((h >> np.uint64(64 - TABLE.bit_length() + 1)).astype(np.int64))
        owners.append(owner[at])

    n = len(c)
    pair = c[:-1] << np.uint64(21) | c[1:]
    add(pair, np.flatnonzero(~(space[:-1] & space[1:]) & ~space[1:]), 2)
    ending = np.flatnonzero(space[1:] & ~space[:-1])
    add(pair, ending, 3)
    if n > 2:
        triple = pair[:-1] << np.uint64(21) | c[2:]
        add(triple, np.flatnonzero(~space[1:-1] & ~(space[:-2] & space[2:])), 4)
    if n > 3:
        quadruple = triple[:-1] * np.uint64(0x100000001B3) + c[3:]
        inner = ~space[1:-2] & ~space[2:-1] & (space[:-3] ^ space[3:])
        add(quadruple, np.flatnonzero(inner), 5)
    lexicon = np.fromiter((zlib.crc32(w.encode()) for w in words), dtype=np.uint64, count=len(words))
    h = (lexicon * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - TABLE.bit_length() + 1)
    parts.append(h.astype(np.int64))
    owners.append(np.arange(len(words)))
    return np.concatenate(parts), np.concatenate(owners)


def _per_word(values: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(owners, weights=values[:, k], minlength=n) for k in range(values.shape[1])], axis=1)


@dataclass
class Field:
    """Weights of the random field: ``table`` (feature x language), ``steps`` and ``first``."""

    languages: list[str]
    table: np.ndarray
    steps: np.ndarray
    first: np.ndarray

    def potentials(self, words: list[str]) -> np.ndarray:
        """exp(emission) of each word, scaled to at most 1."""
        out = np.empty((len(words), len(self.languages)))
        for start in range(0, len(words), WORDS):
            part = words[start : start + WORDS]
            features, owners = word_features(part)
            e = _per_word(self.table[features], owners, len(part))
            out[start : start + WORDS] = np.exp(np.maximum(e - e.max(axis=1, keepdims=True), -30))
        return out


def posteriors(
    potentials: np.ndarray,
    ids: np.ndarray,
    lengths: np.ndarray,
    steps: np.ndarray,
    first: np.ndarray,
    enter: np.ndarray | None = None,
    leave: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of every word of every sequence, and the summed expected transitions, by forward-backward.

    ``ids`` hold the words of all sequences one after the other. Sequences run
    side by side, longest first, so the work per step shrinks as they end.
    ``enter`` and ``leave`` hold what a piece of a longer sequence gets from the
    words before and behind it; without them a sequence is a whole one.
    """
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    move = np.exp(steps - steps.max())
    ends = np.ones((len(sizes), potentials.shape[1])) if leave is None else leave[order]
    begins = np.exp(first - first.max()) if enter is None else enter[order]
    forward = np.empty((len(ids), potentials.shape[1]), dtype=potentials.dtype)
    active = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), side="right")
    state = None
    for t, n in enumerate(active):
        at = starts[:n] + t
        state = begins * potentials[ids[at]] if t == 0 else (state[:n] @ move) * potentials[ids[at]]
        state /= state.sum(axis=1, keepdims=True)
        forward[at] = state
    marginals = np.empty_like(forward)
    expected = np.zeros_like(move)
    back = ends[:0]
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        if t + 1 < len(active):
            m = active[t + 1]
            later = potentials[ids[at[:m] + 1]] * back[:m]
            here = later @ move.T
            scale = (forward[at[:m]] * here).sum(axis=1, keepdims=True)
            expected += move * (forward[at[:m]].T @ (later / scale))
            back = ends[:n].copy()
            back[:m] = here / here.max(axis=1, keepdims=True)
        else:
            back = ends[:n].copy()
        both = forward[at] * back
        marginals[at] = both / both.sum(axis=1, keepdims=True)
    return marginals, expected


def piecewise_posteriors(
    potentials: np.ndarray, ids: np.ndarray, lengths: np.ndarray, steps: np.ndarray, first: np.ndarray, piece: int = 0
) -> np.ndarray:
    """The marginals of ``posteriors`` in time proportional to the words, however long a sequence is.

    Long sequences are cut into pieces. What a piece does to a message, forward
    and backward, is a matrix; all matrices are made side by side, the messages
    between pieces follow from them, and forward-backward then runs inside all
    pieces at once.
    """
    piece = piece or PIECE
    if not len(lengths) or lengths.max() <= piece:
        return posteriors(potentials, ids, lengths, steps, first)[0]
    k = potentials.shape[1]
    move = np.exp(steps - steps.max())
    counts = -(-lengths // piece)
    owner = np.repeat(np.arange(len(lengths)), counts)
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    sizes = np.minimum(lengths[owner] - rank * piece, piece)
    starts = np.cumsum(sizes) - sizes
    # through[p, a, b]: from language a before a piece to language b at its last word.
    through = np.broadcast_to(np.eye(k), (len(owner), k, k)).copy()
    for t in range(piece):
        at = np.flatnonzero((sizes > t) & (counts[owner] > 1))
        if not len(at):
            break
        # No move leads to the first word of a sequence.
        moved = through[at] @ move if t else np.where(rank[at, None, None] > 0, move, np.eye(k))
        here = moved * potentials[ids[starts[at] + t]][:, None, :]
        through[at] = here / here.max(axis=(1, 2), keepdims=True)
    place = np.cumsum(counts) - counts
    enter, leave = np.empty((len(owner), k)), np.ones((len(owner), k))
    message = np.tile(np.exp(first - first.max()), (len(lengths), 1))
    enter[place] = message
    for j in range(counts.max() - 1):
        longer = np.flatnonzero(counts > j + 1)
        at = place[longer] + j
        here = (message[longer][:, None, :] @ through[at])[:, 0]
        message[longer] = here / here.sum(axis=1, keepdims=True)
        enter[at + 1] = message[longer] @ move
    for j in range(counts.max() - 1, 0, -1):
        at = place[counts > j] + j
        here = (through[at] @ leave[at][:, :, None])[:, :, 0]
        leave[at - 1] = here / here.max(axis=1, keepdims=True)
    return posteriors(potentials, ids, sizes, steps, first, enter, leave)[0]


def _training_sequences(texts: list[list[str]], labels: np.ndarray, rng) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of (document, start, end): whole documents in segments, most of them strung with other languages."""
    segments = []
    for doc, words in enumerate(texts):
        at = 0
        while at < len(words):
            size = int(rng.integers(SEGMENT // 2, SEGMENT * 4))
            segments.append((doc, at, min(at + size, len(words))))
            at += size
    order = rng.permutation(len(segments))
    # Neighbours share a language three times out of four, as words in a text mostly do.
    by_label = [[segments[i] for i in order if labels[segments[i][0]] == k] for k in range(labels.max() + 1)]
    label, sequence, held = 0, [], 0
    while any(by_label):
        if not by_label[label] or rng.random() < 0.25:
            left = np.array([len(b) for b in by_label], dtype=float)
            label = int(rng.choice(len(by_label), p=left / left.sum()))
        segment = by_label[label].pop()
        sequence.append(segment)
        held += segment[2] - segment[1]
        if held >= SEQUENCE:
            yield sequence
            sequence, held = [], 0
    if sequence:
        yield sequence


def train(texts: list[str], languages: list[str]) -> Field | None:
    """Fit the field to labelled texts; None where no text has a word."""
    rows = [(words_of(t), lang) for t, lang in zip(texts, languages)]
    rows = [r for r in rows if r[0]]
    if not rows:
        return None
    names = sorted({lang for _, lang in rows})
    labels = np.array([names.index(lang) for _, lang in rows])
    vocabulary: dict[str, int] = {}
    docs = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words]) for words, _ in rows]
    features, owners = word_features(list(vocabulary))
    k = len(names)
    sequences = list(_training_sequences([w for w, _ in rows], labels, np.random.default_rng(7)))
    ids = np.concatenate([docs[d][a:b] for s in sequences for d, a, b in s])
    truth = np.concatenate([np.full(b - a, labels[d]) for s in sequences for d, a, b in s])
    lengths = np.array([sum(b - a for _, a, b in s) for s in sequences])
    starts = np.cumsum(lengths) - lengths
    inside = np.setdiff1d(np.arange(1, len(ids)), starts, assume_unique=True)
    observed = np.zeros((k, k))
    np.add.at(observed, (truth[inside - 1], truth[inside]), 1)
    exact = np.zeros((len(vocabulary), k))
    np.add.at(exact, (ids, truth), 1)

    table, steps, first = np.zeros((TABLE, k)), np.zeros((k, k)), np.zeros(k)
    squares = [np.full_like(w, 1e-8) for w in (table, steps, first)]
    for _ in range(EPOCHS):
        e = _per_word(table[features], owners, len(vocabulary))
        potentials = np.exp(np.maximum(e - e.max(axis=1, keepdims=True), -30))
        marginals, expected = posteriors(potentials, ids, lengths, steps, first)
        # Every word moves by what it is seen as less what it is taken for.
        residual = (exact - _per_word(marginals, ids, len(vocabulary))) / len(ids)
        gradients = [
            _per_word(residual[owners], features, TABLE) - PENALTY * table,
            (observed - expected) / len(ids),
            (np.bincount(truth[starts], minlength=k) - marginals[starts].sum(axis=0)) / len(ids),
        ]
        for weights, gradient, square in zip((table, steps, first), gradients, squares):
            square += gradient**2
            weights += RATE * gradient / np.sqrt(square)
    return Field(names, table.astype(np.float32), steps, first)


def _held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Field | None:
    """Train on about ``sample`` documents per language among those that are not held out.

    Which documents is decided by a hash of the id, so it does not depend on the
    order or the partitioning. Documents without id, language or text are not used.
    """
    rows = docs.select(F.col("doc_id"), F.col("lang").cast("string").alias("lang"), "text").filter(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~_held_out(F.col("doc_id"))
    )
    # One row per language.
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, sample / n)])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    taken = rows.filter(draw < share[F.col("lang")]).orderBy("doc_id", "text").collect()
    return train([r["text"] for r in taken], [r["lang"] for r in taken])


def label_block(field: Field, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, the number of each word of all texts in order, words per text, and their posteriors."""
    vocabulary: dict[str, int] = {}
    number = vocabulary.setdefault
    # Only numbers are kept of a text, which take less room than its words.
    per_text = []
    for text in texts:
        words = words_of(text)
        per_text.append(np.fromiter((number(w, len(vocabulary)) for w in words), dtype=np.int32, count=len(words)))
    lengths = np.array([len(ids) for ids in per_text])
    ids = np.concatenate(per_text) if per_text else np.empty(0, dtype=np.int32)
    if not len(ids):
        return [], ids, lengths, np.empty((0, len(field.languages)))
    distinct = list(vocabulary)
    potentials = field.potentials(distinct).astype(np.float32)
    filled = lengths[lengths > 0]
    return distinct, ids, lengths, piecewise_posteriors(potentials, ids, filled, field.steps, field.first)


def _predictions(field: Field | None, texts: list[str]) -> tuple[list[str], np.ndarray]:
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if field is None:
        return names, scores
    _, _, lengths, marginals = label_block(field, texts)
    filled = np.flatnonzero(lengths)
    if len(filled):
        starts = (np.cumsum(lengths) - lengths)[filled]
        mean = np.add.reduceat(marginals.astype(np.float64), starts, axis=0) / lengths[filled, None]
        best = mean.argmax(axis=1)
        scores[filled] = np.clip(mean[np.arange(len(filled)), best], 0, 1)
        for row, at in zip(filled.tolist(), best.tolist()):
            names[row] = field.languages[at]
    return names, scores


def identify(docs: DataFrame, field: Field | None) -> DataFrame:
    """Language of every document of ``documents(doc_id, text)``: ``doc_id, held_out, lang_pred, score``.

    ``und`` with score 0 where the text is null, has no letter, or nothing was
    learned. Ties take the first language by name. Every row gives one row; a
    null id is not held out. Only the text takes part in a prediction.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in blocks(batches, BLOCK):
            names, scores = _predictions(shared.value, texts)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(names), pa.array(scores)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def label_words(docs: DataFrame, field: Field) -> DataFrame:
    """Every word with its own language: ``doc_id, position, word, lang, score``.

    Texts that are null or without a letter have no words; every repeated row
    has its own; an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in blocks(batches, BLOCK):
            distinct, ids, lengths, marginals = label_block(shared.value, texts)
            best = marginals.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(np.repeat(np.arange(len(lengths)), lengths))),
                    pa.array(np.concatenate([np.arange(n) for n in lengths] or [[]]).astype(np.int32)),
                    pa.array(distinct, pa.string()).take(pa.array(ids)),
                    pa.array(shared.value.languages).take(pa.array(best)),
                    pa.array(marginals[np.arange(len(best)), best].astype(np.float64)),
                ],
                names=["doc_id", "position", "word", "lang", "score"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, position int, word string, lang string, score double"
    )


def keep_identified(docs: DataFrame, field: Field | None, least: float = 0.3) -> DataFrame:
    """``docs`` without those of unknown language or a score under ``least``; a null ``lang`` becomes the prediction.

    Unknown are texts that are null or without a letter, and all texts if
    nothing was learned; repeated rows are judged alike, further columns stay;
    an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    text, lang = docs.columns.index("text"), docs.columns.index("lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in blocks(iter([batch]), BLOCK, text):
                names, scores = _predictions(shared.value, texts)
                kept = pa.array([n != UNKNOWN and s >= least for n, s in zip(names, scores)], pa.bool_())
                known = [old if old is not None else new for old, new in zip(part.column(lang).to_pylist(), names)]
                part = part.set_column(lang, part.schema.field(lang), pa.array(known, part.schema.field(lang).type))
                yield part.filter(kept)

    return docs.mapInArrow(run, docs.schema)
