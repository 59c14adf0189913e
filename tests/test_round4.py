"""Regressions of the findings on the labelling, principal component and marker steps."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellspark.functions.stats import bh_adjust
from cellspark.operators import de as DE
from cellspark.operators import embed as EM
from cellspark.operators import labels as LB
from cellspark.operators import normalize as NZ


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _layer(spark, x):
    return spark.createDataFrame([(int(c), int(g), float(x[c, g])) for c, g in zip(*np.nonzero(x))], "cell_id long, gene_id long, value double")


def _dense(rows, types, key, value):
    out = np.zeros((1 + max(r["gene_id"] for r in rows), len(types)))
    for r in rows:
        out[r["gene_id"], types.index(r[key])] = r[value]
    return out


@pytest.mark.parametrize("n_types", [1, 8, 19])
def test_cell_sums_are_plain_sums(spark, n_types):
    """Any number of types is added up by ordinary sums, without an object per cell."""
    rng = np.random.default_rng(n_types)
    x = rng.poisson(0.7, size=(30, 25)).astype(float)
    x[3] = 0
    w = rng.normal(size=(25, n_types)).round(3)
    w[rng.random(w.shape) < 0.3] = 0
    names = [f"t{i:02d}" for i in range(n_types)]
    coef = spark.createDataFrame([(names[t], g, float(w[g, t])) for g in range(25) for t in range(n_types) if w[g, t]], "type string, gene_id long, weight double")
    icpt = spark.createDataFrame([(n, 0.1 * i) for i, n in enumerate(names)], "type string, intercept double")
    cells = spark.range(30).withColumnRenamed("id", "cell_id")
    got = LB.classify_cells(_layer(spark, x), cells, coef, icpt)
    d = x @ w + 0.1 * np.arange(n_types)
    found = {r["cell_id"]: r for r in got.collect()}
    assert len(found) == 30
    for c in range(30):
        assert found[c]["predicted_celltype"] == names[int(d[c].argmax())]
        assert abs(found[c]["decision"] - d[c].max()) < 1e-9
        assert abs(found[c]["confidence"] - 1 / np.exp(d[c] - d[c].max()).sum()) < 1e-9
    per_gene = LB._per_gene(coef, LB._type_array(icpt.select("type")), "weight")
    sums = LB._summed(_layer(spark, x), per_gene, F.col("value"), F.lit(1.0))
    assert "summarizer" not in _plan(sums).lower() and "partial_sum" in _plan(sums)
    for r in sums.collect():
        c = r["cell_id"]
        assert np.allclose(r["_sums"], np.concatenate([x[c] @ w, (x[c] > 0) @ w]))


def test_model_is_taken_from_the_layer_once(spark):
    """The tables that scoring reads several times are written."""
    x = np.random.default_rng(2).poisson(1.0, size=(12, 6)).astype(float)
    labels = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(12)], "cell_id long, kind string")
    coef, icpt = LB.centroid_model(_layer(spark, x), labels, "kind")
    assert all("Exchange" not in _plan(t) and "Aggregate" not in _plan(t) for t in (coef, icpt))
    mean = np.stack([x[0::2].mean(0), x[1::2].mean(0)], axis=1)
    assert np.allclose(_dense(coef.collect(), ["a", "b"], "type", "weight"), mean)
    assert np.allclose([r["intercept"] for r in icpt.orderBy("type").collect()], -0.5 * (mean * mean).sum(0))


def test_vectors_are_filled_in_from_stored_entries(spark):
    """reading the vectors again repeats neither a join nor a grouping."""
    x = np.random.default_rng(4).poisson(0.6, size=(40, 7)).astype(float)
    x[5] = 0
    cells = spark.range(40).withColumnRenamed("id", "cell_id")
    scaled, stats = NZ.scale(_layer(spark, x), cells, 10.0)
    full = NZ.dense_vectors(scaled, stats, cells)
    assert not any(step in _plan(full) for step in ("Exchange", "Aggregate", "Join"))
    z = np.clip((x - x.mean(0)) / x.std(0, ddof=1), -10, 10)
    got = {r["cell_id"]: r["vec"] for r in full.collect()}
    assert len(got) == 40 and np.allclose([got[c] for c in range(40)], z)
    emb, _, _ = EM.pca(scaled, stats, cells, 3)
    y = np.array([r["vec"] for r in emb.orderBy("cell_id").collect()])
    assert np.allclose(np.sort(y.var(0, ddof=1))[::-1], np.sort(np.linalg.eigvalsh(np.cov(z.T)))[::-1][:3])


def test_adjusted_p_values_need_one_sort(spark):
    """Ranks and the running minimum share a sort; nulls and ties as before."""
    rows = [("g", i, p) for i, p in enumerate([0.01, 0.02, 0.02, 0.5, 0.04, 1.0])] + [("h", 1, 0.3), ("n", 1, None), ("n", 2, 0.2)]
    df = spark.createDataFrame(rows, "group string, gene_id long, pval double")
    out = bh_adjust(df, "pval", ["group"], "padj", order_cols=["gene_id"])
    assert out._jdf.queryExecution().sparkPlan().toString().count("Window") == 3
    assert _plan(out.repartition(1)).count("Sort [") == 1
    got = {(r["group"], r["gene_id"]): r["padj"] for r in out.collect()}
    want = {("g", 0): 0.04, ("g", 1): 0.04, ("g", 2): 0.04, ("g", 4): 0.06, ("g", 3): 0.6, ("g", 5): 1.0, ("h", 1): 0.3, ("n", 1): 0.2, ("n", 2): 0.2}
    assert all(abs(got[k] - v) < 1e-12 for k, v in want.items()) and len(got) == len(want)


def test_rank_entries_are_counted_once(spark, monkeypatch):
    """the entries per gene, value and group are a written table that offsets and ranks read."""
    written = []
    keep = DE.materialize
    monkeypatch.setattr(DE, "materialize", lambda df: written.append(df.columns) or keep(df))
    x = np.random.default_rng(5).poisson(1.0, size=(12, 4)).astype(float)
    labels = spark.createDataFrame([(i, "ab"[i % 2], "st"[i % 3 // 2]) for i in range(12)], "cell_id long, group string, stratum string")
    sums = DE.rank_sums(_layer(spark, x), labels, "group", ["stratum"])
    assert written == [["stratum", "gene_id", "value", "group", "n", "_b"]]
    total = {(r["stratum"], r["gene_id"]): r["t"] for r in sums.groupBy("stratum", "gene_id").agg(F.sum("r_nz_local").alias("t")).collect()}
    for i, s in enumerate("st"):
        n = (x[[c for c in range(12) if "st"[c % 3 // 2] == s]] != 0).sum(0)
        assert all(total.get((s, g), 0.0) == n[g] * (n[g] + 1) / 2 for g in range(4))
