"""Connected components of a distributed edge table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.operators.skew import hot_limit, split_join
from ratingloom.session import durable


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Link the larger (or smaller) neighbours of every node to its smallest neighbour."""
    if larger:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
    else:
        both = edges.toDF("u", "v")
    # Summed before the shuffle and stored, so that a node with many links is no hot key: its links are dealt out.
    least = durable(both.groupBy("u").agg(F.min("v").alias("least"), F.count("*").alias("n")), "least")
    least = least.select("u", F.least("u", "least").alias("m"), "n")
    joined = split_join(both, least, "u", hot_limit(least))
    if larger:
        linked = joined.filter("v > u").select("v", "m")
    else:
        linked = joined.select("v", "m").union(least.select("u", "m"))
    return linked.toDF("a", "b").filter("a > b").distinct()


def _state(edges: DataFrame) -> tuple[int, int, int]:
    """Count and checksums of distinct edges; equal tables have equal ones."""
    code = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(code), F.bit_xor(F.xxhash64(code, "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``edges(a, b)``: component is the smallest node it reaches.

    Nodes are of any type that has an order. Alternates large and small stars
    (Kiveris et al., 2014) until nothing changes, in about log(nodes) rounds; each
    round is stored, so lost executors cost no earlier one. Loops, repeated and
    reversed edges are allowed; a loop alone is no node. An empty table gives none.
    """
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    current = durable(ordered, "edges")
    state, before = _state(current), None
    while state[0] and state != before:
        current = durable(_stars(durable(_stars(current, True), "edges"), False), "edges")
        state, before = _state(current), state
    roots = current.select("b").distinct()
    return current.toDF("node", "component").union(roots.select("b", "b"))
