"""Regressions of the third round of findings."""

import tempfile

import numpy as np
from pyspark.sql import functions as F

from cellspark.operators import graph as GR
from cellspark.sources import io as IO


def test_samples_go_to_the_genes(spark):
    """what is broadcast for the feature files are the samples, not genes x samples."""
    genes = spark.range(500).select(F.col("id").alias("gene_id"), (F.col("id") + 1).alias("row"))
    samples = spark.createDataFrame([("a",), ("b",), (None,)], "sample string")
    got = IO._with_samples(genes, samples)
    assert got.count() == 1500 and got.where("sample IS NULL").count() == 500
    plan = got._jdf.queryExecution().executedPlan().toString()
    sent = plan[plan.index("BroadcastExchange"):]
    assert "Range" in plan[:plan.index("BroadcastExchange")] and "Range" not in sent and "Generate" not in plan


def test_file_without_genes_is_an_empty_table(spark):
    """no gene is significant, so no file was written for that part."""
    de = spark.createDataFrame([("g1", 1, 2.0, 0.1, 0.5, 1.0), ("g2", 2, 3.0, 0.2, 0.5, 1.0)],
                               "group string, gene_id long, score double, logfc double, pval double, padj double")
    path = tempfile.mkdtemp(prefix="cellspark-de-")
    IO.write_de(de, path, 0.05, 0.5, 1)
    n = {p: IO.read_de(spark, path, p, de.columns).count() for p in ("all", "significant", "top1", "combined")}
    assert n == {"all": 2, "significant": 0, "top1": 2, "combined": 2}
    rows = {(r["group"], r["gene_id"], r["score"], r["rank"]) for r in IO.read_de(spark, path, "top1", de.columns).collect()}
    assert rows == {("g1", "1", "2.0", "1"), ("g2", "2", "3.0", "1")}


def test_exact_neighbours_in_blocks_of_slabs(spark):
    """Blocks hold several slabs, and a bound on the distance loses nothing."""
    rng = np.random.default_rng(3)
    pts = rng.normal(size=(150, 6)).round(1)
    pts[20:50] = pts[20]
    vectors = spark.createDataFrame([(int(i), [float(v) for v in p]) for i, p in enumerate(pts)], "cell_id long, vec array<double>")
    got = {(r["src"], r["rank"]): r["dst"] for r in GR.knn(vectors, k=4, slab_size=5).collect()}
    ids = np.arange(150)
    reach = np.empty(150)
    for i in range(150):
        d = np.sqrt(((pts - pts[i]) ** 2).sum(1))
        near = sorted((d[j], j) for j in range(150) if j != i)[:4]
        reach[i] = near[-1][0]
        assert [got[i, r + 1] for r in range(4)] == [j for _, j in near]
    src, dst, _ = GR._topk_block(ids, pts, ids, pts, 4, reach)
    assert all(got[i, r] == j for i, r, j in zip(src, np.tile([1, 2, 3, 4], 150), dst, strict=True))


def test_one_table_per_diffusion_round(spark, monkeypatch):
    """with as many components as cells the second round has converged, and each
    round writes one table."""
    rng = np.random.default_rng(1)
    w = np.triu(rng.uniform(0.1, 1, (7, 7)), 1)
    w += w.T
    graph = spark.createDataFrame([(f"c{i}", f"c{j}", float(w[i, j])) for i in range(7) for j in range(7) if i != j], "src string, dst string, weight double")
    written, write = [], GR.materialize
    monkeypatch.setattr(GR, "materialize", lambda df: written.append(df.columns) or write(df))
    vectors, found = GR.diffusion_components(graph, n_comps=7)
    assert len(written) <= 4  # edges, two rounds, the result
    k = w / np.outer(w.sum(1), w.sum(1))
    t = k / np.sqrt(np.outer(k.sum(1), k.sum(1)))
    assert np.allclose(found, np.linalg.eigvalsh(t)[::-1])
    v = np.zeros((7, 7))
    for r in vectors.collect():
        v[int(r.cell_id[1:]), r.comp] = r.value
    assert np.allclose(t @ v, v * found) and np.allclose(v.T @ v, np.eye(7))
