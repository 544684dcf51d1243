import numpy as np
import pyarrow as pa
import pytest

from ratingloom.llm import bloom


@pytest.mark.parametrize("most", [1 << 29, 1 << 16])
def test_no_key_is_missed_and_few_others_pass(spark, monkeypatch, most):
    monkeypatch.setattr(bloom, "MOST_BITS", most)
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 30_000)
    table = spark.createDataFrame([(int(k),) for k in keys] + [(None,)], "k long").repartition(5)
    found = bloom.build_filter(table)
    assert found.of(keys).all()
    others = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 30_000)
    assert found.of(others).mean() < (0.05 if most > 1 << 16 else 0.6)
    assert found.mask(pa.array([int(keys[0]), None])).to_pylist() == [True, False]


def test_empty(spark):
    assert not bloom.build_filter(spark.createDataFrame([], "k long")).of(np.arange(100)).any()
