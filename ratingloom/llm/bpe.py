"""Byte-level BPE encoding and decoding over a pair occurrence index.

The distinct words of a block of documents lie end to end in one symbol array
with links to the previous and next symbol. An index maps every mergeable pair
to all its positions in the block. Active ranks are applied in ascending order:
one step merges all occurrences of a pair, and the pairs that appear left and
right of the new symbols are appended to their lists. Entries that a merge made
stale are recognised by their symbols when their rank comes up.

A merge creates a symbol that only later ranks use, so ascending order over the
block gives each word the same result as merging it alone.
"""

import ctypes
import gc
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: how byte-level BPE cuts text into words.
WORD = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
# A space after white space and before white space or the end: there, runs between spaces depend on each other.
_IRREGULAR = regex.compile(r"  |\s (?:\s|\Z)|[\x1c-\x1f]")
# What all such places contain, in UTF-8; searched first, since most texts have none of it.
_SUSPECT = [b"  ", b"\n ", b"\t ", b"\r ", b"\x0b ", b"\x0c ", b"\x1c", b"\x1d", b"\x1e", b"\x1f"]
_SUSPECT += [b"\xc2\x85 ", b"\xc2\xa0 ", b"\xe1\x9a\x80 ", b"\xe2\x80", b"\xe2\x81\x9f ", b"\xe3\x80\x80 "]
# Text encoded with one index, in characters.
BLOCK = 1 << 21


def _byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary file."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _irregular(text: str) -> bool:
    data = text.encode()
    return any(s in data for s in _SUSPECT) and _IRREGULAR.search(text) is not None


class Vocabulary:
    """Merges, token bytes and special tokens of a byte-level BPE file."""

    def __init__(self, definition: str):
        parsed = json.loads(definition)
        alphabet = _byte_alphabet()
        ids = parsed["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for token, number in ids.items():
            self.token_bytes[number] = bytes(alphabet[c] for c in token)
        for content, number in self.special.items():
            self.token_bytes[number] = content.encode()
        self.byte_ids = np.zeros(256, dtype=np.int64)
        for char, byte in alphabet.items():
            self.byte_ids[byte] = ids[char]
        merges = [m.split(" ") if isinstance(m, str) else m for m in parsed["model"]["merges"]]
        self.size = size
        self.left = np.array([ids[a] for a, _ in merges], dtype=np.int64)
        self.right = np.array([ids[b] for _, b in merges], dtype=np.int64)
        self.merged = np.array([ids[a + b] for a, b in merges], dtype=np.int64)
        keys = self.left * size + self.right
        self._order = np.argsort(keys, kind="stable")
        self._keys = keys[self._order]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it does not merge."""
        if not len(self._keys):
            return np.full(len(left), -1, dtype=np.int64)
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._order[at], -1)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as little-endian unsigned 32-bit integers."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        if not lengths.sum():
            return [b""] * len(words)
        symbols = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        n = len(symbols)
        ends = np.cumsum(lengths)
        following = np.arange(1, n + 1)
        following[ends[lengths > 0] - 1] = -1
        previous = np.arange(-1, n - 1)
        previous[(ends - lengths)[lengths > 0]] = -1
        alive = np.ones(n, dtype=bool)

        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(positions: np.ndarray) -> None:
            ranks = self.ranks(symbols[positions], symbols[following[positions]])
            kept = ranks >= 0
            positions, ranks = positions[kept], ranks[kept]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            starts = np.concatenate(([0], cuts))
            for rank, part in zip(ranks[starts].tolist(), np.split(positions, cuts)):
                if rank in index:
                    index[rank].append(part)
                else:
                    index[rank] = [part]
                    heapq.heappush(active, rank)

        add(np.flatnonzero(following >= 0))
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            left, right = self.left[rank], self.right[rank]
            after = following[at]
            valid = alive[at] & (after >= 0) & (symbols[at] == left) & (symbols[after] == right)
            at, after = at[valid], after[valid]
            if not len(at):
                continue
            if left == right:
                # Of overlapping occurrences every second one merges, from the left.
                chained = np.concatenate(([False], after[:-1] == at[1:]))
                start = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
                chosen = (np.arange(len(at)) - start) % 2 == 0
                at, after = at[chosen], after[chosen]
            symbols[at] = self.merged[rank]
            alive[after] = False
            beyond = following[after]
            following[at] = beyond
            linked = beyond >= 0
            previous[beyond[linked]] = at[linked]
            before = previous[at]
            add(np.unique(np.concatenate((before[before >= 0], at[linked]))))

        kept = np.concatenate(([0], np.cumsum(alive)))
        flat = symbols[alive].astype("<u4").tobytes()
        cuts = kept[ends].tolist()
        begins = kept[ends - lengths].tolist()
        return [flat[4 * b : 4 * e] for b, e in zip(begins, cuts)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, special tokens in the text included, from one index over all of them."""
        special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        # A run between single spaces is cut on its own, so its ids can be reused; kept with and without the space.
        bare: dict[str, bytes] = {}
        spaced: dict[str, bytes] = {}

        def parts(text: str) -> list[tuple[str, bool]]:
            marked = any(s in text for s in self.special)
            return [(piece, _irregular(piece)) for piece in (special.split(text) if marked else (text,))]

        bare_keys: set[str] = set()
        spaced_keys: set[str] = set()
        for text in texts:
            for piece, irregular in parts(text):
                if irregular:
                    bare_keys.update(WORD.findall(piece))
                else:
                    runs = piece.split(" ")
                    bare_keys.add(runs[0])
                    spaced_keys.update(runs[1:])
        cut = {False: {k: WORD.findall(k) for k in bare_keys}, True: {k: WORD.findall(" " + k) for k in spaced_keys}}
        words = list({w for keys in cut.values() for found in keys.values() for w in found})
        ids = dict(zip(words, self.encode_words([w.encode() for w in words])))
        for with_space, result in ((False, bare), (True, spaced)):
            for key, found in cut[with_space].items():
                result[key] = b"".join([ids[w] for w in found])

        out = []
        for text in texts:
            pieces = parts(text)
            markers = iter(special.findall(text) if len(pieces) > 1 else ())
            line: list[bytes] = []
            for piece, irregular in pieces:
                if irregular:
                    line += [bare[w] for w in WORD.findall(piece)]
                else:
                    runs = piece.split(" ")
                    line.append(bare[runs[0]])
                    line += map(spaced.__getitem__, runs[1:])
                marker = next(markers, None)
                if marker is not None:
                    line.append(int(self.special[marker]).to_bytes(4, "little"))
            out.append(b"".join(line))
        return out

    def decode(self, ids: bytes) -> str:
        """Text of the ids; bytes that are not UTF-8 become replacement characters."""
        numbers = np.frombuffer(ids, dtype="<u4").tolist()
        return b"".join(map(self.token_bytes.__getitem__, numbers)).decode("utf-8", "replace")


def pieces(text: str, limit: int) -> Iterator[str]:
    """``text`` in pieces of about ``limit`` characters that are encoded and decoded as in the whole text.

    A piece begins at a space between two other characters: there a word begins
    whatever stands before. A text without such a place stays whole.
    """
    start = 0
    while len(text) - start > limit:
        at = text.find(" ", start + limit)
        while 0 < at < len(text) - 1 and (text[at - 1].isspace() or text[at + 1].isspace()):
            at = text.find(" ", at + 1)
        if not 0 < at < len(text) - 1:
            break
        yield text[start:at]
        start = at
    yield text[start:]


def load_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        return Vocabulary(file.read())


def release_memory() -> None:
    """Give back what this process no longer holds: a worker lives on for the tasks of later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    # The C library keeps freed memory unless asked; not every one can be asked.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def blocks(
    batches: Iterator[pa.RecordBatch], limit: int = BLOCK, column: int = -1
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Runs of rows whose texts (the last column, null as empty) have about ``limit`` characters at most."""
    for batch in batches:
        column %= batch.num_columns
        start, held, lengths = 0, 0, pc.utf8_length(batch.column(column)).to_pylist()
        for i, length in enumerate(lengths):
            held += length or 0
            if held >= limit or i + 1 == len(lengths):
                part = batch.slice(start, i + 1 - start)
                yield part, [t or "" for t in part.column(column).to_pylist()]
                start, held = i + 1, 0
    release_memory()


def transcode(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Encode and decode every text: the input rows with ``ids`` (binary) and ``decoded``.

    ``docs(doc_id, text)``; the text itself is not returned. Ids are
    little-endian unsigned 32-bit integers, equal to those of the tokenizers
    library without added special tokens; a special token that stands in the
    text is encoded as itself. A null text counts as empty and gives no ids.
    Every row gives one row, also repeated ones and those without id. The
    vocabulary (some MB, whatever the data) is sent to the executors once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        divisible = not any(" " in token for token in vocabulary.special)
        for part, texts in blocks(batches):
            if len(texts) == 1 and divisible:
                # A long text is encoded piece by piece, so that what is held at once does not grow with it.
                encoded, shown = [], []
                for piece in pieces(texts[0], BLOCK):
                    encoded += vocabulary.encode([piece])
                    shown.append(vocabulary.decode(encoded[-1]))
                ids, decoded = [b"".join(encoded)], ["".join(shown)]
            else:
                ids = vocabulary.encode(texts)
                decoded = [vocabulary.decode(x) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                names=["doc_id", "ids", "decoded"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, ids binary, decoded string"
    )


def digests(transcoded: DataFrame, *more: str) -> DataFrame:
    """Digest columns of ``transcode``, and the columns named in ``more``."""
    return transcoded.select(
        "doc_id",
        *more,
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
