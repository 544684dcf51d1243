"""Removal of byte strings that occur before, by bucket-pointer refinement.

Which strings of 100 bytes are equal is the order of all suffixes to depth 100.
Every such window is dealt to the bucket of one of its q-grams, its anchor: the
first of those with the least hash, so equal windows meet in the same bucket.
About one q-gram in 39 is an anchor; it stands for the up to 77 windows that
chose it, which travel together as one stretch of text. Anchors that occur once
are buckets of one and go no further.

Inside a task the stretches are refined as in Schürmann and Stoye (2007): first
buckets by the 25-gram at each offset, then by the pair (own bucket, bucket 25
further on), which orders to depth 50, and by the buckets of that order 50
further on, to depth 100. Buckets of one drop out on the way.

An anchor with very many occurrences is divided into its single windows, each a
bucket of its own, and equal stretches of a block leave it once. So a passage in
a third of all documents sends one row per block and window, not per document.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.bloom import Filter, build_filter
from ratingloom.llm.bpe import blocks
from ratingloom.session import durable

LENGTH = 100
GRAM = 24
# Text of which equal stretches leave a task once, in characters.
BLOCK = 1 << 23
# Grams inside a window, so windows per anchor at most.
WINDOW = LENGTH - GRAM + 1
BUCKET_GRAM = 25
# Occurrences beyond which an anchor is divided into windows.
HOT = 20_000
# Positions hashed at once, in the processor's cache.
_CHUNK = 1 << 16
# Bytes of text refined at once.
_REFINED = 1 << 22
_LAST_ID = (1 << 63) - 1

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: int, n: int) -> np.uint64:
    return np.uint64(pow(base, n, 1 << 64))


_BASE = 0xD1342543DE82EF95


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hash (64 bits) of the ``size`` bytes from each position, by doubling."""
    one = data.astype(np.uint64) + np.uint64(1)
    n = len(data) - size + 1
    total, done, block, width = None, 0, one, 1
    while True:
        if size & width:
            part = block[done : done + n]
            total = part.copy() if total is None else total * _powers(_BASE, width) + part
            done += width
        if 2 * width > size:
            return total
        block = block[: len(block) - width] * _powers(_BASE, width) + block[width:]
        width *= 2


def _strong(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * _MIX
    h ^= h >> np.uint64(29)
    return h * np.uint64(0xBF58476D1CE4E5B9)


def _hashed(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash (64 bits) of the ``size`` bytes at each of the positions ``at``."""
    words = np.zeros((len(at), -(-size // 8) * 8), dtype=np.uint8)
    if len(at):
        words[:, :size] = data[at[:, None] + np.arange(size)]
    h = np.zeros(len(at), dtype=np.uint64)
    for word in words.view("<u8").T:
        h = _strong(h * _MIX + word)
    return h.view(np.int64)


def anchors(data: np.ndarray) -> np.ndarray:
    """Position of the anchor of the window at each position of ``data``."""
    n = len(data) - LENGTH + 1
    found = np.empty(max(n, 0), dtype=np.int64)
    for start in range(0, n, _CHUNK):
        piece = data[start : start + _CHUNK + LENGTH - 1]
        order = _strong(gram_hashes(piece, GRAM)) & np.uint64(0xFFFFFFFF00000000)
        least = order | np.arange(len(order), dtype=np.uint64)
        width = 1
        while 2 * width <= WINDOW:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = WINDOW - width
        least = np.minimum(least[: len(least) - rest], least[rest:])
        found[start : start + len(least)] = (least & np.uint64(0xFFFFFFFF)).astype(np.int64) + start
    return found


def stretches(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, and per stretch: document (position), first window, windows, and the hash of the anchor."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(lengths)
    at = anchors(data)
    # Windows that leave their document belong to none.
    inside = np.zeros(len(at) + 1, dtype=np.int64)
    long = lengths >= LENGTH
    inside[(ends - lengths)[long]] += 1
    np.subtract.at(inside, ends[long] - LENGTH + 1, 1)
    valid = np.cumsum(inside[:-1]) > 0
    change = np.ones(len(at), dtype=bool)
    change[1:] = at[1:] != at[:-1]
    first = np.flatnonzero(valid & (change | ~np.concatenate(([False], valid[:-1]))))
    stop = np.flatnonzero(valid & np.concatenate((change[1:] | ~valid[1:], [True])))
    owner = np.searchsorted(ends, first, side="right")
    return data, owner, first, stop - first + 1, _hashed(data, at[first], GRAM)


def _encoded(texts: list[str]) -> list[bytes]:
    return [t.encode() for t in texts]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, texts in blocks(batches, BLOCK):
        hashes, n = np.unique(stretches(_encoded(texts))[4], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(n.astype(np.int64))], names=["anchor", "n"])


def _emit(repeated: Filter, hot: Filter):
    """Stretches of repeated anchors; equal ones leave a block once, the others are marked as found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in blocks(batches, BLOCK):
            # In order of documents, so that the first of equal stretches is the earliest.
            ids, keys = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            order = np.lexsort((keys, ids))
            ids, keys = ids[order], keys[order]
            encoded = [texts[i].encode() for i in order]
            starts = np.concatenate(([0], np.cumsum([len(t) for t in encoded])))
            data, owner, first, n, h = stretches(encoded)
            kept = repeated.of(h)
            owner, first, n, h = owner[kept], first[kept], n[kept], h[kept]
            many = hot.of(h)
            if many.any():
                # Every window of a divided anchor becomes a stretch with a bucket of its own.
                nth = np.concatenate([np.arange(c) for c in n[many]])
                whole = np.flatnonzero(many).repeat(n[many])
                at = first[whole] + nth
                own = _hashed(data, at, LENGTH)
                parts = (
                    (owner[~many], owner[whole]),
                    (first[~many], at),
                    (n[~many], np.ones(len(at), dtype=n.dtype)),
                    (h[~many], own),
                )
                owner, first, n, h = (np.concatenate(p) for p in parts)
                order = np.argsort(first, kind="stable")
                owner, first, n, h = owner[order], first[order], n[order], h[order]
            raw = data.tobytes()
            text = [raw[a : a + c + LENGTH - 1] for a, c in zip(first.tolist(), n.tolist())]
            seen: set[bytes] = set()
            fresh = np.array([not (t in seen or seen.add(t)) for t in text], dtype=bool)
            # Equal ids and texts are one document: the same place twice is not a repetition.
            place = first - starts[owner]
            if len(first):
                twin = {}
                for i in np.flatnonzero(~fresh):
                    twin.setdefault((ids[owner[i]], keys[owner[i]], place[i]), []).append(i)
                if twin:
                    for i in np.flatnonzero(fresh):
                        for j in twin.get((ids[owner[i]], keys[owner[i]], place[i]), ()):
                            fresh[j] = True
            # What is settled goes anywhere.
            h = np.where(fresh, h, _strong(first.astype(np.uint64)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h),
                    pa.array(ids[owner]),
                    pa.array(keys[owner]),
                    pa.array(place.astype(np.int32)),
                    pa.array(n.astype(np.int32)),
                    pa.array([t if f else None for t, f in zip(text, fresh)], pa.binary()),
                ],
                names=["anchor", "id", "text_key", "first", "n", "text"],
            )

    return run


def _buckets(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket number of each key, and the size of its bucket."""
    _, number, size = np.unique(keys, return_inverse=True, return_counts=True)
    return number, size[number]


def refine(texts: list[bytes], windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that equal an earlier window: stretch, offset, and the flat position of the first of its bucket.

    ``windows[i]`` windows begin at the first offsets of ``texts[i]``.
    """
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    # Buckets of the 25-grams, and pointers to them by position.
    bucket, _ = _buckets(gram_hashes(data, BUCKET_GRAM))
    stretch = np.repeat(np.arange(len(texts)), windows)
    offset = np.arange(len(stretch)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = starts[stretch] + offset
    # To depth 50 at the windows and 50 bytes on; windows alone in their bucket need no more.
    pair = bucket.astype(np.int64) * (len(data) + 1)
    number, size = _buckets(pair[at] + bucket[at + BUCKET_GRAM])
    at, stretch, offset, number = (x[size > 1] for x in (at, stretch, offset, number))
    half, _ = _buckets(pair[at + 2 * BUCKET_GRAM] + bucket[at + 3 * BUCKET_GRAM])
    number, size = _buckets(number.astype(np.int64) * (len(at) + 1) + half)
    at, stretch, offset, number = (x[size > 1] for x in (at, stretch, offset, number))
    _, first, number = np.unique(number, return_index=True, return_inverse=True)
    origin = at[first][number]
    later = origin != at
    return stretch[later], offset[later], origin[later]


def _same(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the windows at ``a`` equal those at ``b`` byte by byte."""
    eight = np.zeros(max(len(data) - 7, 0), dtype=np.uint64)
    for k in range(8):
        eight |= data[k : k + len(eight)].astype(np.uint64) << np.uint64(8 * k)
    steps = [*range(0, LENGTH - 8, 8), LENGTH - 8]
    return all(np.array_equal(eight[a + s], eight[b + s]) for s in steps)


def _exact(texts: list[bytes], windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``refine``, comparing windows themselves; for the case that two 25-grams share a hash."""
    seen: set[bytes] = set()
    found = [(i, k) for i, t in enumerate(texts) for k in range(windows[i]) if t[k : k + LENGTH] in seen or seen.add(t[k : k + LENGTH])]
    return np.array([f[0] for f in found], dtype=np.int64), np.array([f[1] for f in found], dtype=np.int64)


def _refined(rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Intervals of the rows' documents that repeat earlier text, and the rows with a window that does not."""
    rows = rows.sort_values(["id", "text_key", "first"], kind="stable")
    # The same place twice is one row that was in the input twice.
    rows = rows.drop_duplicates(["anchor", "id", "text_key", "first"])
    texts, n = rows["text"].tolist(), rows["n"].to_numpy(np.int64)
    stretch, offset, origin = refine(texts, n)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    starts = np.cumsum([len(t) for t in texts]) - np.array([len(t) for t in texts])
    if len(stretch) and not _same(data, starts[stretch] + offset, origin):
        stretch, offset = _exact(texts, n)
    # Runs of neighbouring windows are one interval.
    opens = np.ones(len(stretch), dtype=bool)
    opens[1:] = (stretch[1:] != stretch[:-1]) | (offset[1:] != offset[:-1] + 1)
    ends = np.concatenate((opens[1:], [True])) if len(stretch) else opens
    row = stretch[opens]
    first = rows["first"].to_numpy(np.int64)[row]
    origins = rows[np.bincount(stretch, minlength=len(rows)) < n]
    found = pd.DataFrame(
        {
            "id": rows["id"].to_numpy(np.int64)[row],
            "text_key": rows["text_key"].to_numpy(np.int64)[row],
            "start": first + offset[opens],
            "end": first + offset[ends] + LENGTH,
        }
    )
    return found, origins


def _refine_sorted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Buckets of rows sorted by anchor and place, a few MB at a time.

    Of a bucket larger than that only the rows stay that hold the first of equal
    windows: one for each window of a divided anchor, and less than ``HOT`` others.
    """
    held: list[pd.DataFrame] = []
    size = 0
    for frame in frames:
        settled = frame["text"].isna()
        if settled.any():
            known = frame.loc[settled, ["id", "text_key", "first", "n"]]
            known["end"] = known["first"].astype(np.int64) + known.pop("n") + LENGTH - 1
            yield known.rename(columns={"first": "start"})
            frame = frame[~settled]
        held.append(frame)
        size += frame["text"].str.len().sum()
        if size < _REFINED:
            continue
        rows = pd.concat(held, ignore_index=True)
        found, origins = _refined(rows)
        yield found
        # The next rows may belong to the last bucket, which has no end yet.
        held, size = [origins[origins["anchor"] == rows["anchor"].iat[-1]]], 0
    if held and sum(map(len, held)):
        yield _refined(pd.concat(held, ignore_index=True))[0]


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, removed, runs = [], [], []
        for text, starts, ends in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
            data = (text or "").encode()
            if not starts:
                kept.append(data)
                removed.append(0)
                runs.append(0)
                continue
            order = np.argsort(np.array(starts), kind="stable")
            begin, end = np.array(starts)[order], np.maximum.accumulate(np.array(ends)[order])
            opens = np.concatenate(([True], begin[1:] > end[:-1]))
            begin, end = begin[opens].tolist(), end[np.concatenate((opens[1:], [True]))].tolist()
            edges = [0, *(x for pair in zip(begin, end) for x in pair), len(data)]
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
            removed.append(len(data) - len(kept[-1]))
            runs.append(len(begin))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64())],
            names=["doc_id", "kept", "n_removed", "n_spans"],
        )


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """``doc_id, kept, n_removed, n_spans`` of every document of ``documents(doc_id, text)``.

    ``kept`` (bytes) is the UTF-8 text without the bytes covered by a string of
    100 bytes that also starts earlier: in a smaller ``doc_id``, or before in the
    same document. Strings are judged on the input and never cross documents;
    ``n_spans`` counts maximal removed runs. A null text counts as empty. Rows
    with the same id and text are one document, each of them reported; rows with
    the same id and another text are documents in the order of a hash of the
    text. A null id comes last. Further columns are ignored; an empty table gives
    no rows. ``hot`` only decides how the work is dealt out.
    """
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID)).alias("id"),
        F.xxhash64("text").alias("text_key"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text"),
    )
    texts = rows.select("id", "text_key", "text")
    counted = rows.select("text").mapInArrow(_count, "anchor long, n long")
    repeated = durable(counted.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1"), "repeat-anchors")
    filters = build_filter(repeated.select("anchor")), build_filter(repeated.filter(F.col("n") > hot).select("anchor"))
    found = texts.mapInArrow(
        _emit(*filters), "anchor long, id long, text_key long, first int, n int, text binary"
    )
    ordered = found.repartition("anchor").sortWithinPartitions("anchor", "id", "text_key", "first")
    refined = ordered.mapInPandas(_refine_sorted, "id long, text_key long, start long, end long")
    spans = (
        refined.groupBy("id", "text_key")
        .agg(F.collect_list(F.struct("start", "end")).alias("spans"))
        .select(F.col("id").alias("span_id"), F.col("text_key").alias("span_key"), "spans")
    )
    joined = rows.join(spans, (F.col("id") == F.col("span_id")) & (F.col("text_key") == F.col("span_key")), "left")
    return joined.select("doc_id", "text", "spans.start", "spans.end").mapInArrow(
        _remove, "doc_id long, kept binary, n_removed long, n_spans long"
    )


def digests(removed: DataFrame) -> DataFrame:
    """Sizes and digest of ``remove_repeats``."""
    return removed.select(
        "doc_id",
        (F.octet_length("kept") + F.col("n_removed")).cast("long").alias("n_bytes"),
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )
