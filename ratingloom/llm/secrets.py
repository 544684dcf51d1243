"""Secret scan through nested encodings by a recursive decoding worklist.

Every document starts a worklist of layers. A layer is scanned, then unwrapped:
percent-encoding and Unicode escapes over the whole layer, base64 run by run,
gzip and zlib inside base64. New layers go back on the list until nothing new
appears; a layer already seen at the same place is not entered again, so cycles
end. Each layer knows which characters of the document its own come from, and
findings are reported there.
"""

import base64
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import blake2b
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.bpe import blocks, release_memory

KINDS = ("assign", "access", "hex")
# The forms of the secrets and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile(r"[0-9a-f]+")
# Runs of this length or more; shorter ones fail anyway.
HEX_LONG = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
# Runs that go on over line breaks, as base64 is wrapped.
_BREAK = re.compile(r"\r?\n[ \t]*")
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}(?:\r?\n[ \t]*[A-Za-z0-9+/_-]+)+={0,2}")
# Where compressed data can begin behind text that a run is glued to.
_SEPARATOR = re.compile(r"[/_-]")
_GLUED = re.compile(r"(?<=[/_-])(?:H4sI|e[A-P])")
# Bytes unfolded at once, and of a window of compressed data that is scanned at once; it ends at a space,
# or at HELD bytes without one, and the next begins OVERLAP bytes before its end, or up to three more.
PIECE, WINDOW, HELD, OVERLAP = 1 << 18, 1 << 21, 1 << 22, 1 << 14
_ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
_WRAPS = b"\r\n\t"


@dataclass(frozen=True)
class Layer:
    """Text with the place of each character in the document (None: its own) and the way it was reached."""

    text: str
    starts: np.ndarray | None = None
    ends: np.ndarray | None = None
    via: str = ""

    def place(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        return int(self.starts[start]), int(self.ends[end - 1])

    def child(self, text: str, starts: np.ndarray, ends: np.ndarray, how: str) -> "Layer":
        """A layer whose character i comes from [starts[i], ends[i]) of this one."""
        if self.starts is not None:
            starts, ends = self.starts[starts], self.ends[ends - 1]
        return Layer(text, starts, ends, f"{self.via}>{how}" if self.via else how)


def scan_text(text: str) -> list[tuple[int, str, int]]:
    """``(start, kind, end)`` of the secrets that stand in the text itself."""
    found = []
    lowered = text.lower()
    if any(w in lowered for w in _WORDS):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(m.start(), "hex", m.end()) for m in HEX_LONG.finditer(text)]
    return found


def _replaced(layer: Layer, pieces: list[tuple[int, int, str, list[int]]], how: str) -> Layer:
    """``layer`` with [start, end) replaced by a text whose characters begin at the given places."""
    out, starts, ends, at = [], [], [], 0
    for start, end, text, places in pieces:
        out += [layer.text[at:start], text]
        plain = np.arange(at, start)
        bounds = np.array([*places, end])
        starts += [plain, bounds[:-1]]
        ends += [plain + 1, bounds[1:]]
        at = end
    plain = np.arange(at, len(layer.text))
    out.append(layer.text[at:])
    starts.append(plain)
    ends.append(plain + 1)
    return layer.child("".join(out), np.concatenate(starts).astype(np.int64), np.concatenate(ends).astype(np.int64), how)


def _url(layer: Layer) -> Layer | None:
    if "%" not in layer.text:
        return None
    pieces = []
    for m in _PERCENT.finditer(layer.text):
        data = bytes.fromhex(m[0].replace("%", ""))
        text = data.decode("utf-8", "replace")
        # A character takes as many escapes as it has bytes; replaced bytes take one each or share the rest.
        places, at = [], m.start()
        exact = text.encode() == data
        for char in text:
            places.append(min(at, m.end() - 3))
            at += 3 * (len(char.encode()) if exact else 1)
        pieces.append((m.start(), m.end(), text, places))
    return _replaced(layer, pieces, "url") if pieces else None


def _unicode(layer: Layer) -> Layer | None:
    if "\\u" not in layer.text and "\\x" not in layer.text and "&#" not in layer.text:
        return None
    pieces = []
    for m in _ESCAPE.finditer(layer.text):
        code = int(m[5]) if m[5] else int(m[1] or m[2] or m[3] or m[4], 16)
        if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000:
            pieces.append((m.start(), m.end(), chr(code), [m.start()]))
    return _replaced(layer, pieces, "unicode") if pieces else None


def _packed(data: bytes) -> bool:
    return data[:2] == b"\x1f\x8b" or (len(data) > 2 and data[0] == 0x78 and (data[0] * 256 + data[1]) % 31 == 0)


def _pieces(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """Contents of gzip or zlib data, member after member, up to its end or a fault."""
    tool = zlib.decompressobj(47)
    for data in chunks:
        while True:
            try:
                out = tool.decompress(data, PIECE)
            except zlib.error:
                return
            if out:
                yield out
            if tool.eof:
                data, tool = tool.unused_data.lstrip(b"\0"), zlib.decompressobj(47)
                if not data:
                    break
            else:
                data = tool.unconsumed_tail
                if not data and len(out) < PIECE:
                    break


def _windows(pieces: Iterable[bytes]) -> Iterator[bytes]:
    held = b""
    for piece in pieces:
        held += piece
        if len(held) < WINDOW:
            continue
        cut = held.rfind(b" ", 2 * OVERLAP)
        if cut < 0:
            if len(held) < HELD:
                continue
            cut = len(held)
        # An even cut keeps the two bytes of UTF-16 together.
        cut -= cut % 2
        yield held[:cut]
        held = held[_in_step(held, cut - OVERLAP) :]
    if held:
        yield held


def _in_step(data: bytes, at: int) -> int:
    """The last place up to ``at`` where four characters of a base64 run begin, if it lies in one.

    A window that begins there decodes the rest of the run as the whole run would
    be decoded, whether it is wrapped into lines or not.
    """
    head = data[:at]
    start = len(head.rstrip(_ALPHABET + _WRAPS))
    over = sum(len(part) for part in head[start:].translate(None, _WRAPS).split()) % 4
    while over:
        at -= 1
        over -= data[at] in _ALPHABET
    return at


def _unfolded(data: bytes) -> tuple[str, Iterator[bytes]] | None:
    """Way and windows of what gzip or zlib data unfolds to, through all its compressed layers."""
    if not _packed(data):
        return None
    how, first, pieces, seen = "", data, iter(()), set()
    while _packed(first) and first not in seen:
        seen.add(first)
        inner = _pieces(chain([first], pieces))
        begun = next(inner, None)
        if begun is None:
            break
        how, first, pieces = f"{how}>compressed", begun, inner
    return (how, _windows(chain([first], pieces))) if how else None


def _texts(data: bytes) -> Iterator[tuple[str, np.ndarray]]:
    """Readings of ``data``, each with the bytes its characters take: UTF-8 or else bytes, and UTF-16 where NULs alternate."""
    try:
        text = data.decode("utf-8")
        widths = np.ones(len(text), dtype=np.int64) if len(text) == len(data) else [len(c.encode()) for c in text]
    except UnicodeDecodeError:
        text, widths = data.decode("latin-1"), np.ones(len(data), dtype=np.int64)
    yield text, np.asarray(widths)
    for code, high in (("utf-16-le", data[1::2]), ("utf-16-be", data[::2])):
        # A secret within other scripts still has this many.
        if high.count(0) >= 6:
            wide = data[: len(data) // 2 * 2].decode(code, "replace")
            yield wide, np.array([4 if ord(c) > 0xFFFF else 2 for c in wide], dtype=np.int64)


def _decoded(run: str) -> bytes:
    """Bytes of ``run``, without what its last characters leave unfinished."""
    run = run[: len(run) - 1] if len(run) % 4 == 1 else run
    return base64.b64decode(run.replace("-", "+").replace("_", "/") + "=" * (-len(run) % 4))


def _runs(text: str) -> Iterator[tuple[str, np.ndarray, int, list[int]]]:
    """Base64 runs, each line and wrapped lines joined: characters, their places, the end, starts of lines in the run."""
    for m in _BASE64.finditer(text):
        yield m[0].rstrip("="), np.arange(m.start(), m.end()), m.end(), []
    for m in _WRAPPED.finditer(text):
        lines, places, starts, at, n = [], [], [], m.start(), 0
        for line in _BREAK.finditer(text, m.start(), m.end()):
            lines.append(text[at : line.start()])
            places.append(np.arange(at, line.start()))
            n += line.start() - at
            starts.append(n)
            at = line.end()
        lines.append(text[at : m.end()])
        places.append(np.arange(at, m.end()))
        yield "".join(lines).rstrip("="), np.concatenate(places), m.end(), starts


def _base64(layer: Layer) -> Iterator[Layer]:
    for run, places, stop, lines in _runs(layer.text):
        # What a run is glued to shifts it by 0 to 3 characters; compressed data must begin at its first byte.
        glued = [m.start() for m in _GLUED.finditer(run)]
        glued += [n for n in lines if run.startswith(("H4sI", "eA", "eJ", "eN", "eF"), n)]
        shifts = {0, *(m.end() % 4 for m in _SEPARATOR.finditer(run)), *(n % 4 for n in lines)}
        for skip in [*sorted(shifts), *sorted(set(glued) - shifts)]:
            if not skip and not lines and len(run) % 4 == 1:
                continue
            data, how = _decoded(run[skip:]), "base64"
            opened = _unfolded(data)
            if skip not in shifts and opened is None:
                continue
            if opened is not None:
                # Compressed data maps to the whole run.
                how = f"base64{opened[0]}"
            for data, (text, widths) in ((d, t) for d in (opened[1] if opened else [data]) for t in _texts(d)):
                if not text:
                    continue
                if how == "base64":
                    first = np.minimum(np.cumsum([0, *widths]), len(data))
                    last = len(run) - 1
                    starts = places[np.minimum(skip + first[:-1] // 3 * 4, last)]
                    final = skip + (np.maximum(first[1:], 1) - 1) // 3 * 4 + 3
                    # The padding belongs to the last characters.
                    ends = np.where(final > last, stop, places[np.minimum(final, last)] + 1)
                else:
                    starts = np.full(len(text), places[skip])
                    ends = np.full(len(text), stop)
                yield layer.child(text, starts, ends, how)


def _children(layer: Layer) -> Iterator[Layer]:
    for unwrapped in (_url, _unicode):
        child = unwrapped(layer)
        if child is not None and child.text != layer.text:
            yield child
    for child in _base64(layer):
        if child.text != layer.text:
            yield child


def scan_layers(text: str) -> list[tuple[int, str, int, str]]:
    """``(start, kind, end, via)`` of all secrets, those of the text itself with an empty ``via``."""
    found = {(start, kind, end): "" for start, kind, end in scan_text(text)}
    # One child of each open layer at a time, so that unfolded windows are not held together.
    worklist, seen = [_children(Layer(text))], set()
    while worklist:
        child = next(worklist[-1], None)
        if child is None:
            worklist.pop()
            continue
        where = (child.place(0, len(child.text)), blake2b(child.text.encode("utf-8", "surrogatepass"), digest_size=16).digest())
        if where in seen:
            continue
        seen.add(where)
        for start, kind, end in scan_text(child.text):
            start, end = child.place(start, end)
            found.setdefault((start, kind, end), child.via)
        worklist.append(_children(child))
    order = sorted(found.items(), key=lambda f: (f[0][0], KINDS.index(f[0][1]), f[0][2]))
    return [(start, kind, end, via) for (start, kind, end), via in order]


FINDINGS = "array<struct<kind:string,start:int,end:int,via:string>>"


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, findings`` of every document of ``documents(doc_id, text)``.

    Findings come by start, then kind; positions are code points, the end is
    exclusive; ``via`` names the decoded layers, empty for the text itself. What
    is found in the text itself stays, whatever the layers add; the same span of
    the same kind is reported once. Compressed layers are read whole,
    in windows. A null text counts as empty; every row gives one row, further columns are
    ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("via", pa.string())])
        )
        for part, texts in blocks(batches):
            found = [
                [{"kind": k, "start": s, "end": e, "via": v} for s, k, e, v in scan_layers(text)] for text in texts
            ]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, kind)], names=["doc_id", "findings"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, f"doc_id long, findings {FINDINGS}"
    )


def digests(found: DataFrame) -> DataFrame:
    """Counts and digest columns of ``find_secrets``."""

    def joined(findings: Column) -> Column:
        return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")

    base = F.filter("findings", lambda f: f["via"] == "")
    counts = [F.size(F.filter(base, lambda f: f["kind"] == k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans")
    )


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by ``mask``; overlapping findings become one.

    Null and empty texts stay as they are, repeated rows are masked alike, an
    empty table gives none; further columns pass through.
    """
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text in batch.column(at).to_pylist():
                spans = scan_layers(text) if text else []
                out, done = [], 0
                for start, _, end, _ in spans:
                    if start >= done:
                        out += [text[done:start], mask]
                    done = max(done, end)
                texts.append("".join([*out, text[done:]]) if spans else text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
        release_memory()

    return docs.mapInArrow(run, docs.schema)
