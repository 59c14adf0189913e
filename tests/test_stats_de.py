"""Hand-sized checks of the sparse formulas against dense brute force."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellspark.functions.stats import bh_adjust, erfc, ln_factorial
from cellspark.operators import de as DE
from cellspark.operators import normalize as NZ


def test_erfc_and_ln_factorial(spark):
    xs = [0.0, 0.1, 0.5, 1.0, 2.5, 5.0, 10.0, 26.0, -1.0, -3.0]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", erfc("x").alias("e")).collect()
    for r in got:
        ref = math.erfc(r["x"])
        assert abs(r["e"] - ref) <= 1.2e-7 * max(ref, 1e-300) + 1e-300
    ks = list(range(0, 40)) + [100, 1000, 20000]
    got = spark.createDataFrame([(k,) for k in ks], "k long").select("k", ln_factorial("k").alias("l")).collect()
    for r in got:
        assert abs(r["l"] - math.lgamma(r["k"] + 1)) < 1e-9 * max(1.0, math.lgamma(r["k"] + 1))


def test_bh_matches_definition(spark):
    p = [0.01, 0.04, 0.03, 0.2, 0.04, 0.9]
    df = spark.createDataFrame([("g", i, v) for i, v in enumerate(p)], "group string, gene_id long, pval double")
    got = {r["gene_id"]: r["padj"] for r in bh_adjust(df, "pval", ["group"]).collect()}
    order = np.argsort(p, kind="stable")
    m = len(p)
    adj = np.minimum.accumulate((np.array(p)[order] * m / np.arange(1, m + 1))[::-1])[::-1]
    for rank, i in enumerate(order):
        assert abs(got[i] - min(1.0, adj[rank])) < 1e-12



def _avg_rank(v):
    return pd.Series(v).rank(method="average").to_numpy()


def test_rank_genes_vs_dense(spark):
    rng = np.random.default_rng(7)
    n_cells, n_genes = 40, 6
    x = rng.poisson(0.7, size=(n_cells, n_genes)).astype(float)
    x[:, 0] = 1.0           # a gene present in every cell with one tied value (hot key)
    x[:, 1] = 0.0           # an all-zero gene
    x[:5, 1] = [2, 2, 2, 3, 3]
    groups = np.array(["a"] * 12 + ["b"] * 18 + ["c"] * 10)
    counts = [(int(i), int(j), float(x[i, j])) for i in range(n_cells) for j in range(n_genes) if x[i, j] != 0]
    layer = spark.createDataFrame(counts, "cell_id long, gene_id long, value double")
    labels = spark.createDataFrame([(int(i), str(g)) for i, g in enumerate(groups)], "cell_id long, grp string")
    genes = spark.createDataFrame([(j,) for j in range(n_genes)], "gene_id long")
    out = {(r["group"], r["gene_id"]): r for r in
           DE.rank_genes(layer, labels, "grp", genes=genes, bucket_width=0.5).collect()}
    n = n_cells
    for g in "abc":
        m = groups == g
        n1, n2 = m.sum(), n - m.sum()
        for j in range(n_genes):
            r = _avg_rank(x[:, j])
            z = (r[m].sum() - n1 * (n + 1) / 2) / math.sqrt(n1 * n2 * (n + 1) / 12)
            lf = math.log2((math.expm1(x[m, j].mean()) + 1e-9) / (math.expm1(x[~m, j].mean()) + 1e-9))
            got = out[(g, j)]
            assert abs(got["score"] - z) < 1e-9
            assert abs(got["logfc"] - lf) < 1e-9
            assert abs(got["pval"] - math.erfc(abs(z) / math.sqrt(2))) < 1e-6


def test_hvg_moments_match_dense(spark):
    rng = np.random.default_rng(3)
    x = rng.poisson(1.0, size=(30, 5)).astype(float)
    layer = spark.createDataFrame([(i, j, float(np.log1p(x[i, j]))) for i in range(30) for j in range(5) if x[i, j]],
                                  "cell_id long, gene_id long, value double")
    cells = spark.createDataFrame([(i,) for i in range(30)], "cell_id long")
    mom = {r["gene_id"]: r for r in NZ.gene_moments(layer, 30).collect()}
    for j in range(5):
        v = np.log1p(x[:, j])
        assert abs(mom[j]["mean"] - v.mean()) < 1e-12
        assert abs(mom[j]["var"] - v.var(ddof=1)) < 1e-12
    scaled, stats = NZ.scale(layer, cells, 10.0)
    st = {r["gene_id"]: r for r in stats.collect()}
    for j in range(5):
        v = np.log1p(x[:, j])
        assert abs(st[j]["zero_value"] - (0 - v.mean()) / v.std(ddof=1)) < 1e-9


def test_rank_against_equals_brute_force(spark, capsys):
    """Each group against the reference cells outside it, by comparing all pairs of cells."""
    import math
    import random

    from cellspark.operators import de as DE
    rng = random.Random(8)
    cells = [(f"c{i}", rng.choice(["a", "b", "c", None]), rng.choice(["healthy", "leukemia", None])) for i in range(60)]
    genes = [f"g{j}" for j in range(5)]
    value = {(c, g): rng.choice([0.0, 0.0, 0.5, 1.0, 1.04, 3.0]) for c, _, _ in cells for g in genes[:4]}  # g4 has no entry
    layer = spark.createDataFrame([(c, g, v) for (c, g), v in value.items()], "cell_id string, gene_id string, value double")
    table = spark.createDataFrame(cells, "cell_id string, cluster string, health_status string")
    out = DE.rank_clusters_vs_healthy(layer, table, "cluster", ["a", "b", "nobody"], genes=spark.createDataFrame([(g,) for g in genes], "gene_id string"))
    out.explain("formatted")
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got = {(r.group, r.gene_id): (r.score, r.logfc) for r in out.collect()}
    assert set(got) == {(g, x) for g in "ab" for x in genes}
    for (g, x), (score, logfc) in got.items():
        one = [value.get((c, x), 0.0) for c, k, _ in cells if k == g]
        two = [value.get((c, x), 0.0) for c, k, h in cells if k != g and h == "healthy"]
        u = sum((v > w) + 0.5 * (v == w) for v in one for w in two)
        n1, n2 = len(one), len(two)
        assert score == pytest.approx((u - n1 * n2 / 2) / math.sqrt(n1 * n2 * (n1 + n2 + 1) / 12), abs=1e-9)
        mean = [math.expm1(sum(v) / len(v)) + 1e-9 for v in (one, two)]
        assert logfc == pytest.approx(math.log2(mean[0] / mean[1]), abs=1e-9)
    listed = {(r.group, r.gene_id): r.score for r in DE.rank_clusters_vs_healthy(layer, table, "cluster", table.where("cluster IN ('a', 'b')").select("cluster")).collect()}
    assert listed == {k: v[0] for k, v in got.items() if k[1] != "g4"}
    vs = {(r.group, r.gene_id) for r in DE.rank_genes(layer, table, "cluster", reference="c").collect()}
    assert vs == {(g, x) for g in "ab" for x in genes[:4]}
    with pytest.raises(ValueError):
        DE.rank_clusters_vs_healthy(layer, table, "cluster", []).collect()
