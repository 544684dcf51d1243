"""Near-duplicate documents by circulant MinHash, with exact Jaccard verification.

Two permutations of the circle of 2^32 points make all signature coordinates:
the first spreads the shingles, the second is applied after a circular shift by
k for coordinate k (Li and Li, 2022). Bands of five coordinates out of 200 make
buckets; a pair of similarity 0.8 shares none with probability 1.3e-7.

Equal sets are one class from the start, whatever ids they come with. Signatures
that agree in 130 of 200 coordinates, compared inside the buckets, make families:
first every class with the smallest class of its buckets, then what still differs
inside a bucket, in tiles of bounded size, each of which returns a forest and not
its pairs. A family holds every link of its members. Their full sets meet once, in
tiles again, and a search from set to set that drops what it has reached links
them exactly. So a group of copies of any size never becomes all its pairs, and no
link between different components is lost. Ids come in at the end: the sets of one
id are one document.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.bloom import Filter, build_filter
from ratingloom.llm.bpe import blocks
from ratingloom.llm.graph import components
from ratingloom.llm.words import documents
from ratingloom.operators.skew import hot_limit, split_join
from ratingloom.session import durable

SHINGLE = 4
BANDS, ROWS = 40, 5
# Links have 100 * intersection >= SIMILARITY * union.
SIMILARITY = 80
# Agreeing coordinates, of 200, that a pair of similarity 0.8 misses by five standard deviations.
AGREEING = 130
# Members of a bucket or family, and shingles of a family, on one side of a tile.
TILE, TILE_SHINGLES = 2048, 1 << 21
# Shingles hashed at once; the arrays stay in the processor's cache.
_RUN = 1 << 15
# Text held at once, in characters.
_BLOCK = 1 << 20

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_PLACE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


def _length_term(words: int) -> np.uint64:
    return np.uint64(words * 0xFF51AFD7ED558CCD % 2**64)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (64 bits) of each text."""
    hashes = _WordHashes()
    words = [(t or "").encode().translate(_LOWER).split() for t in texts]
    counts = [len(w) for w in words]
    flat = np.fromiter((hashes[w] for ws in words for w in ws), dtype=np.uint64, count=sum(counts))
    place = np.resize(_PLACE, size) * np.arange(1, 2 * size, 2, dtype=np.uint64)
    n = len(flat) - size + 1
    rolled = np.zeros(max(n, 0), dtype=np.uint64)
    for i in range(size):
        if n > 0:
            rolled += flat[i : i + n] * place[i]
    rolled = _mixed(rolled + _length_term(size))
    out, start = [], 0
    for count in counts:
        if count >= size:
            out.append(np.unique(rolled[start : start + count - size + 1]))
        elif count:
            short = (flat[start : start + count] * place[:count]).sum(keepdims=True)
            out.append(_mixed(short + _length_term(count)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
        start += count
    return out


def signatures_of(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """Circulant MinHash signatures, one row per non-empty set."""
    lengths = np.array([len(s) for s in sets])
    result = np.empty((len(sets), coordinates), dtype=np.uint32)
    ends = np.cumsum(lengths)
    first = 0
    while first < len(sets):
        base = ends[first] - lengths[first]
        last = max(int(np.searchsorted(ends, base + _RUN, side="right")), first + 1)
        starts = (ends[first:last] - lengths[first:last] - base).astype(np.int64)
        # The first permutation: a bijection of 64 bits, of which 32 are the point on the circle.
        point = (np.concatenate(sets[first:last]) >> np.uint64(32)).astype(np.uint32)
        value, shifted = np.empty_like(point), np.empty_like(point)
        for k in range(coordinates):
            # The second permutation, after a shift by k.
            np.add(point, np.uint32(k), out=value)
            np.multiply(value, np.uint32(0x85EBCA6B), out=value)
            np.right_shift(value, np.uint32(15), out=shifted)
            np.bitwise_xor(value, shifted, out=value)
            np.multiply(value, np.uint32(0xC2B2AE35), out=value)
            np.right_shift(value, np.uint32(13), out=shifted)
            np.bitwise_xor(value, shifted, out=value)
            np.multiply(value, np.uint32(0x27D4EB2F), out=value)
            result[first:last, k] = np.minimum.reduceat(value, starts)
        first = last
    return result


def _set_hashes(sets: list[np.ndarray]) -> pa.Array:
    return pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary())


def codes_of(signed: np.ndarray) -> np.ndarray:
    """One byte per coordinate. The low one: minima of large sets have few high bits."""
    return (signed & np.uint32(255)).astype(np.uint8)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in blocks(batches, _BLOCK):
        sets = shingle_sets(texts)
        filled = [s for s in sets if len(s)]
        signed = signatures_of(filled, BANDS * ROWS)
        grouped = signed.reshape(len(filled), BANDS, ROWS)
        bands = np.zeros((len(filled), BANDS), dtype=np.uint64)
        for row in range(ROWS):
            bands = _mixed(bands + grouped[:, :, row].astype(np.uint64))
        bands = _mixed(bands + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
        codes = codes_of(signed)
        rows = iter(range(len(filled)))
        place = [next(rows) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                part.column(0).cast(pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                _set_hashes(sets),
                pa.array([None if p is None else bands[p] for p in place], pa.list_(pa.int64())),
                pa.array([None if p is None else codes[p].tobytes() for p in place], pa.binary()),
            ],
            names=["doc_id", "n_shingles", "set_hash", "bands", "code"],
        )


def _sets_of(wanted: Filter):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = (batch.filter(wanted.mask(batch.column(0))) for batch in batches)
        for _, texts in blocks(kept, _BLOCK):
            found = [s for s in shingle_sets(texts) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [_set_hashes(found), pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))],
                names=["set_hash", "shingles"],
            )

    return sets


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs ``(a, b)`` whose codes agree often enough."""
    for batch in batches:
        if not batch.num_rows:
            continue
        left, right = (
            np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1)
            for i in (2, 3)
        )
        yield batch.select([0, 1]).filter(pa.array((left == right).sum(axis=1) >= AGREEING))


def _by_tile(forest: Callable[[pd.DataFrame], list[tuple[int, int]]]):
    """Run ``forest`` on every whole tile of frames sorted by ``key, i, j``."""

    def emit(whole: pd.DataFrame) -> pd.DataFrame:
        keys = whole[["key", "i", "j"]].to_numpy()
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        found = set()
        for part in np.split(np.arange(len(whole)), cuts):
            if len(part) > 1:
                found.update(forest(whole.iloc[part]))
        return pd.DataFrame(sorted(found), columns=["a", "b"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            if not len(held):
                continue
            keys = held[["key", "i", "j"]].to_numpy()
            last = (keys == keys[-1]).all(axis=1)
            if not last.all():
                yield emit(held[~last])
                held = held[last].reset_index(drop=True)
        if held is not None and len(held):
            yield emit(held)

    return run


def _code_forest(tile: pd.DataFrame) -> list[tuple[int, int]]:
    """Edges that join the components of a tile whose codes are alike."""
    ids, component = tile["node"].to_numpy(), tile["component"].to_numpy().copy()
    codes = np.frombuffer(b"".join(tile["code"]), dtype=np.uint8).reshape(len(ids), -1)
    edges = []
    for at in range(len(ids)):
        others = np.flatnonzero(component != component[at])
        if not len(others):
            break
        alike = others[(codes[others] == codes[at]).sum(axis=1) >= AGREEING]
        reached, first = np.unique(component[alike], return_index=True)
        edges += [(ids[at], ids[o]) for o in alike[first]]
        component[np.isin(component, reached)] = component[at]
    return edges


def _set_forest(tile: pd.DataFrame) -> list[tuple[int, int]]:
    """Edges of similarity enough that connect what is connected in a tile, by exact intersection."""
    ids, sets = tile["node"].to_numpy(), tile["shingles"].tolist()
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    own = [flat[e - n : e] for e, n in zip(ends.tolist(), sizes.tolist())]
    marked = np.zeros(len(values), dtype=np.int32)
    left, edges = np.arange(len(ids)), []
    while len(left):
        # One component: every set reached is compared with those not yet reached.
        waiting, left = [left[0]], left[1:]
        joined, starts = None, None
        while waiting and len(left):
            at = waiting.pop()
            if joined is None:
                joined = np.concatenate([own[i] for i in left])
                starts = np.cumsum(sizes[left]) - sizes[left]
            marked[own[at]] = 1
            shared = np.add.reduceat(marked[joined], starts)
            marked[own[at]] = 0
            linked = 100 * shared >= SIMILARITY * (sizes[at] + sizes[left] - shared)
            if linked.any():
                edges += [(ids[at], ids[o]) for o in left[linked]]
                waiting += left[linked].tolist()
                left, joined = left[~linked], None
    return edges


def _tiled(members: DataFrame, *columns: str) -> DataFrame:
    """``members(key, tiles, node, ...)``, nodes distinct inside a key: one row for every tile a member is in."""
    return (
        members.withColumn("side", F.pmod(F.xxhash64("node"), "tiles").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select("key", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "node", *columns)
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "node")
    )


def _families(classes: DataFrame) -> DataFrame:
    """``sid, key`` of every class that may have links: those of one key hold all links of each other."""
    codes = classes.select("sid", "code")
    buckets = classes.select("sid", F.explode("bands").alias("key"))
    leaders = buckets.groupBy("key").agg(F.min("sid").alias("leader"), F.count("*").alias("n")).filter("n > 1")
    leaders = durable(leaders, "minhash-leaders")
    shared = durable(split_join(buckets, leaders, "key", hot_limit(leaders)), "minhash-buckets")

    stars = shared.filter("sid > leader").select(F.col("sid").alias("a"), F.col("leader").alias("b")).distinct()
    # Both sides of the joins are stored tables, so a leader of very many classes is divided at run time.
    stars = durable(stars, "minhash-pairs")
    stars = stars.join(codes.toDF("a", "code_a"), "a").join(codes.toDF("b", "code_b"), "b")
    alike = stars.select("a", "b", "code_a", "code_b").mapInArrow(_alike, "a long, b long")
    families = durable(components(alike), "minhash-families").toDF("sid", "component")

    members = shared.select("key", "sid").join(families, "sid", "left")
    members = members.withColumn("component", F.coalesce("component", "sid"))
    mixed = members.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n")
    )
    mixed = mixed.filter("low < high").select("key", F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))
    across = members.join(durable(mixed, "minhash-mixed"), "key").join(codes, "sid").withColumnRenamed("sid", "node")
    across = _tiled(across, "component", "code").mapInPandas(_by_tile(_code_forest), "a long, b long")
    across = durable(across, "minhash-across")
    if not across.isEmpty():
        families = durable(components(families.union(across).toDF("a", "b")), "minhash-families")
    return families.toDF("sid", "key")


def _set_links(docs: DataFrame, classes: DataFrame, families: DataFrame) -> DataFrame:
    """Edges ``a, b`` between set hashes that connect what is connected by links of full sets."""
    members = classes.select("set_hash", "sid", "doc_id", "n_shingles").join(families, "sid")
    members = durable(members, "minhash-members")
    counts = members.groupBy("key").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles"))
    counts = counts.filter("n > 1").select(
        "key",
        F.greatest(F.ceil(F.col("n") / TILE), F.ceil(F.col("shingles") / TILE_SHINGLES)).cast("int").alias("tiles"),
    )
    # The filter only spares sets that no family needs; the join decides.
    wanted = build_filter(members.select("doc_id").distinct())
    sets = docs.mapInArrow(_sets_of(wanted), "set_hash binary, shingles array<long>").dropDuplicates(["set_hash"])
    named = members.join(durable(counts, "minhash-tiles"), "key").select("set_hash", "key", "tiles")
    tiles = _tiled(sets.join(named, "set_hash").withColumnRenamed("set_hash", "node"), "shingles")
    return tiles.mapInPandas(_by_tile(_set_forest), "a binary, b binary")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Component of every document of ``documents(doc_id, text)``: ``doc_id, n_shingles, component_id, kept``.

    Words are runs without white space, A-Z in lower case; a set holds the
    distinct shingles of four words, or the whole sequence where there are fewer
    words. Documents without words are linked with nothing. One row per input
    row: rows that repeat a ``doc_id`` are one document, whose links are those of
    all its texts. A null ``doc_id`` takes no part: its component is null and it
    is kept. ``kept`` marks the smallest id of a component. Further columns are
    ignored; an empty table gives no rows.
    """
    docs = documents(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = durable(
        docs.mapInArrow(
            _sign, "doc_id long, n_shingles long, set_hash binary, bands array<long>, code binary"
        ),
        "minhash-signatures",
    )
    linked = signed.filter(F.col("set_hash").isNotNull() & F.col("doc_id").isNotNull())
    # Up to the exact check classes go by 64 bits of their hash: what meets by chance is only one more candidate.
    classes = linked.groupBy("set_hash").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
        F.first("code").alias("code"), F.count("*").alias("n"),
    )
    classes = durable(classes.withColumn("sid", F.xxhash64("set_hash")), "minhash-classes")
    links = _set_links(docs, classes, _families(classes))

    code = F.xxhash64("set_hash")
    several = linked.groupBy("doc_id").agg(F.min(code).alias("low"), F.max(code).alias("high")).filter("low < high")
    several = durable(several.select("doc_id"), "minhash-ids")
    if not several.isEmpty():
        # The sets of one id are one document.
        own = durable(linked.join(several, "doc_id").select("doc_id", "set_hash").distinct(), "minhash-ids")
        firsts = durable(own.groupBy("doc_id").agg(F.min("set_hash").alias("first")), "minhash-ids")
        links = links.union(own.join(firsts, "doc_id").select("set_hash", "first"))

    final = durable(components(links.toDF("a", "b")), "minhash-components").toDF("set_hash", "component")
    sets = classes.select("set_hash", "doc_id", "n").join(final, "set_hash", "left")
    roots = sets.filter("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("root"))
    # Sets of one row that reach no other need no name.
    named = durable(
        sets.join(durable(roots, "minhash-roots"), "component")
        .select("set_hash", F.col("root").alias("component_id"), "n")
        .union(sets.filter("component IS NULL AND n > 1").select("set_hash", "doc_id", "n")),
        "minhash-named",
    )
    # A set with very many copies is dealt to several tasks.
    moved = split_join(linked.select("set_hash", "doc_id"), named, "set_hash", hot_limit(named))
    moved = durable(
        moved.filter(F.col("doc_id") != F.col("component_id"))
        .select(F.col("doc_id").alias("node"), "component_id")
        .distinct(),
        "minhash-moved",
    )
    return signed.join(moved, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"),
    )
