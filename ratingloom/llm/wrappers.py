"""Main text of web pages by wrapper induction.

The pages of a host share a template. The most common layout of a host gives its
seed, a page of that layout; every other page of the host is aligned with it by
simple tree matching. A leaf whose text is the same on most pages is template,
all else is a varying slot. What of a page lies in varying slots, within its
article and outside of its menus, notices, forms and the like, is content.

Hosts meet in counts that are summed before they are shuffled, so that a host
with a third of all pages is no hot group; a page is never held with another.
"""

import json
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm import dom
from ratingloom.session import durable

# A leaf is template if, by the lower end of its 95 % interval, at least this share of the host's
# different pages has the same text there. Few pages give no proof.
TEMPLATE_SHARE = 0.75
_Z2 = 3.84
# Layouts, and counts of leaves, that a task sums up before it hands them on.
_HELD = 20_000


def host(url: Column) -> Column:
    """Host of a URL in lower case; empty if there is none."""
    return F.regexp_extract(F.lower(url), r"^\s*[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:\s]+)", 1)


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and layout the number of pages and the least page, as a packed tree."""
    held: dict[tuple[str, str], tuple[int, int, str]] = {}

    def emit() -> pa.RecordBatch:
        rows = [(*key, *value) for key, value in held.items()]
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), _SEED.types)], schema=_SEED
        )

    for batch in batches:
        for name, html in zip(batch.column("host").to_pylist(), batch.column("html")):
            tree = dom.parse(html.as_py())
            key = (name, dom.layout(tree))
            number, nodes, packed = held.get(key, (0, 0, ""))
            count = dom.size(tree)
            if not packed or count <= nodes:
                candidate = json.dumps(dom.packed(tree), separators=(",", ":"))
                if not packed or (count, candidate) < (nodes, packed):
                    nodes, packed = count, candidate
            held[key] = number + 1, nodes, packed
        if len(held) > _HELD:
            yield emit()
    if held:
        yield emit()


_SEED = pa.schema([("host", pa.string()), ("layout", pa.string()), ("n", pa.int64()), ("nodes", pa.int64()), ("seed", pa.string())])
_SEED_DDL = "host string, layout string, n long, nodes long, seed string"


@lru_cache(maxsize=256)
def _tree(packed: str) -> dom.Node:
    return dom.unpacked(json.loads(packed))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host, place in its template and text: digests of the pages that have the text there."""
    held: set[tuple[str, int, int, int]] = set()

    def emit() -> pa.RecordBatch:
        rows = list(held)
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), _COUNT.types)], schema=_COUNT
        )

    for batch in batches:
        for name, html, seed in zip(
            batch.column("host").to_pylist(), batch.column("html"), batch.column("seed")
        ):
            page = dom.parse(html.as_py())
            # Copies of a page are one page: they prove nothing about the template.
            digest = dom.text_digest(page)
            held.add((name, -1, 0, digest))
            held.update(
                (name, place, node.hash, digest)
                for place, node in dom.align(_tree(seed.as_py()), page).items()
                if node.tag == "#"
            )
        if len(held) > _HELD:
            yield emit()
    if held:
        yield emit()


_COUNT = pa.schema([("host", pa.string()), ("place", pa.int32()), ("text_hash", pa.int64()), ("page", pa.int64())])
_COUNT_DDL = "host string, place int, text_hash long, page long"


def _named(pages: DataFrame) -> DataFrame:
    return pages.select(host(F.col("url")).alias("host"), "html").filter("host <> '' AND html IS NOT NULL")


def _seeds_of(named: DataFrame) -> DataFrame:
    """``host, seed``: the packed tree of the host's most common layout (ties: the least digest)."""
    return durable(
        named.mapInArrow(_seeds, _SEED_DDL)
        .groupBy("host", "layout")
        .agg(F.sum("n").alias("n"), F.min(F.struct("nodes", "seed")).alias("least"))
        .groupBy("host")
        .agg(F.min(F.struct(-F.col("n"), "layout", "least"))["least"]["seed"].alias("seed")),
        "seeds",
    )


def _wrappers(seeds: DataFrame, seen: DataFrame) -> DataFrame:
    """Wrappers of ``seeds`` by the distinct ``seen (host, place, text_hash, page)``."""
    per_text = seen.groupBy("host", "place", "text_hash").agg(F.count("*").alias("n"))
    per_place = per_text.groupBy("host", "place").agg(F.max(F.struct("n", "text_hash")).alias("most"))
    # Place -1 counts the host's different pages.
    total = F.max(F.when(F.col("place") == -1, F.col("most.n")))
    leaves = F.collect_list(F.when(F.col("place") >= 0, F.struct("place", "most.text_hash", "most.n")))
    wrappers = per_place.groupBy("host").agg(total.alias("total"), leaves.alias("leaves")).select(
        "host",
        F.transform(
            F.filter("leaves", lambda x: _lower_end(x["n"] / F.col("total"), F.col("total")) >= TEMPLATE_SHARE),
            lambda x: F.struct(x["place"].alias("place"), x["text_hash"].alias("text_hash")),
        ).alias("constants"),
    )
    return durable(seeds.join(wrappers, "host"), "wrappers")


def induce(pages: DataFrame) -> DataFrame:
    """Wrapper of every host of ``pages(url, html)``: ``host, seed, constants``.

    ``seed`` is the packed tree of the host's most common layout (ties: the least
    digest), ``constants`` the places in it whose text is template, with the
    text's hash. Pages without host, and null pages, take no part.
    """
    named = _named(pages)
    seeds = _seeds_of(named)
    seen = named.join(seeds, "host").select("host", "html", "seed").mapInArrow(_counts, _COUNT_DDL).distinct()
    return _wrappers(seeds, seen)


def _lower_end(share: Column, n: Column) -> Column:
    """Lower end of Wilson's interval for a share among ``n``."""
    middle = share + _Z2 / (2 * n)
    return (middle - F.sqrt(_Z2 * (share * (1 - share) / n + _Z2 / (4 * n * n)))) / (1 + _Z2 / n)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, template = [], []
        for html, seed, constants in zip(batch.column("html"), batch.column("seed"), batch.column("constants")):
            page = dom.parse(html.as_py())
            constant = constants.as_py()
            dropped: set[int] = set()
            if constant:
                known = {c["place"]: c["text_hash"] for c in constant}
                dropped = {
                    id(node)
                    for place, node in dom.align(_tree(seed.as_py()), page).items()
                    if node.tag == "#" and known.get(place) == node.hash
                }
            leaves = dom.content_leaves(page)
            kept = [leaf.text for leaf in leaves if id(leaf) not in dropped]
            texts.append("\n".join(kept))
            template.append(len(leaves) - len(kept))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64()), pa.array(template, pa.int64())],
            names=["page_id", "url", "text", "n_chars", "n_template"],
        )


def extract(pages: DataFrame, wrappers: DataFrame | None = None) -> DataFrame:
    """Main text of every row of ``pages(page_id, url, html)``: ``page_id, url, text, n_chars, n_template``.

    The blocks of the article, in page order, joined by one line feed; character
    references are decoded, any white space inside a block is one space, and a
    line break of the markup counts as white space. A page without ``article`` or
    ``main`` element is taken as a whole. Left out are the blocks that the host's
    wrapper (``induce``) proves to be template (``n_template`` counts them), and
    elements whose kind, role or name says that they are no article text: menus,
    headers, footers, sidebars, notices, adverts, forms, scripts, comments.

    A null page is an empty one; repeated rows are rows of their own; pages
    without host, or of a host without proven template, lose no block to a
    wrapper; unclosed and misplaced tags are mended; an empty table gives no row.
    """
    layout = pages.select("page_id", "url").schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in layout)
    if wrappers is None:
        return _extract_once(pages, ddl)
    joined = pages.select("page_id", "url", "html", host(F.col("url")).alias("host")).join(wrappers, "host", "left")
    return joined.select("page_id", "url", "html", "seed", "constants").mapInArrow(
        _extract, f"{ddl}, text string, n_chars long, n_template long"
    )


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page parsed once: its digest and aligned leaves for the wrapper, its content leaves with their places."""
    for batch in batches:
        digests, seen, content = [], [], []
        for html, seed in zip(batch.column("html"), batch.column("seed")):
            page = dom.parse(html.as_py())
            places: dict[int, int] = {}
            if seed.is_valid and html.is_valid:
                # As _counts: copies of a page are one page.
                digests.append(dom.text_digest(page))
                found = dom.align(_tree(seed.as_py()), page)
                seen.append([(place, node.hash) for place, node in found.items() if node.tag == "#"])
                places = {id(node): place for place, node in found.items()}
            else:
                digests.append(None)
                seen.append([])
            content.append([(places.get(id(leaf)), leaf.hash, leaf.text) for leaf in dom.content_leaves(page)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), batch.column("host"), pa.array(digests, pa.int64()),
             pa.array(seen, _PLACED), pa.array(content, _CONTENT)],
            names=["page_id", "url", "host", "page", "seen", "content"],
        )


_PLACED = pa.list_(pa.struct([("place", pa.int32()), ("text_hash", pa.int64())]))
_CONTENT = pa.list_(pa.struct([("place", pa.int32()), ("text_hash", pa.int64()), ("text", pa.string())]))
_PARSED_DDL = (
    "host string, page long, seen array<struct<place int, text_hash long>>, "
    "content array<struct<place int, text_hash long, text string>>"
)


def _extract_once(pages: DataFrame, ddl: str) -> DataFrame:
    """``extract`` with the wrappers of ``pages`` themselves; the pages are parsed for seeds, then once more."""
    rows = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    seeds = _seeds_of(_named(pages))
    parsed = durable(
        rows.join(seeds, "host", "left")
        .select("page_id", "url", "html", "host", "seed")
        .mapInArrow(_parsed, f"{ddl}, {_PARSED_DDL}"),
        "parsed-pages",
    )
    counted = parsed.filter(F.col("page").isNotNull())
    seen = counted.select("host", F.lit(-1).alias("place"), F.lit(0).cast("long").alias("text_hash"), "page").unionByName(
        counted.select("host", F.inline("seen"), "page")
    ).distinct()
    constants = _wrappers(seeds, seen).select("host", F.map_from_entries("constants").alias("constants"))
    joined = parsed.join(constants, "host", "left")

    def template(x: Column) -> Column:
        at = F.try_element_at(F.col("constants"), F.coalesce(x["place"], F.lit(-2)))
        return F.coalesce(at == x["text_hash"], F.lit(False))

    kept = F.filter("content", lambda x: ~template(x))
    text = F.array_join(F.transform(kept, lambda x: x["text"]), "\n")
    return joined.select(
        "page_id",
        "url",
        text.alias("text"),
        F.char_length(text).cast("long").alias("n_chars"),
        (F.size("content") - F.size(kept)).cast("long").alias("n_template"),
    )
