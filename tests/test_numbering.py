"""Distributed numbering against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from cellspark.operators.numbering import number_rows, running


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_running_values_over_hot_and_null_keys(spark, partitions):
    rng = random.Random(partitions)
    keys = ["hot"] * 150 + [None] * 20 + [f"k{rng.randrange(12)}" for _ in range(80)]
    rows = [(k, i, rng.randrange(-1 << 62, 1 << 62)) for i, k in enumerate(keys)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, o long, x long").repartition(5)
    got = {(r.k, r.o): (r.n, r.acc, r.total) for r in running(df.withColumn("y", F.col("o") % 7), ["k"], [F.col("o").desc()], xors={"acc": "x"},
                                                                   sums={"total": "y"}, out_col="n", partitions=partitions).collect()}
    want, state = {}, {}
    for k, o, x in sorted(rows, key=lambda r: -r[1]):
        n, acc, total = state.get(k, (0, 0, 0))
        state[k] = want[k, o] = (n + 1, acc ^ x, total + o % 7)
    assert got == want


def test_number_rows(spark):
    df = spark.createDataFrame([(i * 37 % 101, "x") for i in range(101)] + [(None, "y")], "v long, s string")
    got = number_rows(df, [F.col("v").asc_nulls_first()]).collect()
    assert sorted(r.number for r in got) == list(range(102))
    assert all(r.number == (0 if r.v is None else r.v + 1) for r in got)
    assert number_rows(df.limit(0), [F.col("v")]).collect() == []
    assert number_rows(df, [F.col("v")]).columns == ["v", "s", "number"]
    with pytest.raises(ValueError):
        number_rows(df, [F.col("v")], out_col="s")
