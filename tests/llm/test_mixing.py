import math

import pytest
from pyspark.sql import functions as F

from ratingloom.llm import mixing


def size(text):
    return len("".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ")) - ("".join(
        " " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ").count(""))


def water_fill(sizes):
    """Shares by weight, stopped at twice the size, the excess shared again until none is above."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] > 2 * sizes[s]}
        if not full:
            target |= {s: unit * weight[s] for s in open_}
            break
        for s in full:
            target[s] = 2 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("table", ["small", "odd", "empty"])
def test_report(request, table):
    docs = request.getfixturevalue(table)
    report = [r.asDict() for r in mixing.mix_report(docs).collect()]
    plain = docs.select("doc_id", "source", "text").collect()
    assert sorted((r["doc_id"], r["size"]) for r in report if r["doc_id"]) == sorted((r.doc_id, size(r.text)) for r in plain if r.doc_id)
    assert len(report) == len(plain)
    sizes = {}
    for r in plain:
        sizes[r.source] = sizes.get(r.source, 0) + size(r.text)
    targets = water_fill(sizes)
    expected = sorted((s, round(targets[k], 6)) for k, s in sizes.items() for _ in range(sum(r.source == k for r in plain)))
    got = sorted((r["source_size"], round(r["target"], 6)) for r in report)
    assert all(a[0] == b[0] and math.isclose(a[1], b[1], abs_tol=1e-3) for a, b in zip(got, expected))
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in report)


def test_taken_comes_near_the_targets_and_reruns_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn(
        "source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source"))
    )
    first = mixing.mix_report(docs).cache()
    for r in first.groupBy("source_size").agg(F.sum("taken").alias("t"), F.max("target").alias("target")).collect():
        assert abs(r.t - r.target) <= 0.02 * r.target + 20
    again = mixing.mix_report(docs.repartition(13))
    assert first.exceptAll(again).isEmpty()


def test_tree_splits_quotas_exactly(spark):
    quotas = {"a": 300, "b": 41, None: 9, "z": 0}
    table = spark.createDataFrame(list(quotas.items()), "source string, quota long")
    rows = mixing.split_quotas(table, 7, 3).collect()
    per_source, per_shard = {}, {}
    for r in rows:
        per_source[r.source] = per_source.get(r.source, 0) + r.quota
        per_shard[r.shard] = per_shard.get(r.shard, 0) + r.quota
        assert r.quota >= 0
    assert per_source == quotas
    assert set(per_shard) == set(range(7)) and max(per_shard.values()) - min(per_shard.values()) <= 3
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.split_quotas(table, 7, 3).collect()), key=str)


def test_draws_are_hypergeometric(spark):
    """Blocks of a that the first of two shards gets, over many seeds: mean and spread of the distribution."""
    table = spark.createDataFrame([("a", 30), ("b", 70)], "source string, quota long")
    parts = [mixing.split_quotas(table, 2, seed).filter("shard = 0 and source = 'a'") for seed in range(60)]
    table = parts[0]
    for part in parts[1:]:
        table = table.union(part)
    got = [r.quota for r in table.collect()]
    mean = sum(got) / len(got)
    spread = sum((x - mean) ** 2 for x in got) / len(got)
    assert abs(mean - 15) < 1.2
    assert 0.5 < spread / (50 * 0.3 * 0.7 * 50 / 99) < 1.8


def test_mix_repeats_rows_and_keeps_columns(odd, small):
    report = {r.doc_id: r.taken // r.size for r in mixing.mix_report(small).collect() if r.size}
    rows = mixing.mix(small)
    assert rows.columns == small.columns
    counts = {r.doc_id: r["count"] for r in rows.groupBy("doc_id").count().collect()}
    assert counts == {d: n for d, n in report.items() if n}
    assert mixing.mix(odd).columns == odd.columns
