"""The flow on loaded data: string ids, clashing names, unconnected graphs."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellspark.operators import aggregates as AG
from cellspark.operators import cleaning as CL
from cellspark.operators import enrich as EN
from cellspark.operators import graph as GR
from cellspark.operators import labels as LB
from cellspark.operators import qc as QC
from cellspark.sources import io as IO


def test_unique_names_pass_all_originals(spark):
    names = ["a", "a", "a-1", "a-2", "a", "b", "b", "a-1", None, None]
    df = spark.createDataFrame(list(enumerate(names)), "i long, name string")
    got = [r.u for r in CL.make_unique(df, "name", "i", "u").orderBy("i").collect()]
    assert got == ["a", "a-3", "a-1", "a-2", "a-4", "b", "b-1", "a-1-1", None, None]


def test_prefixed_files(spark):
    d = tempfile.mkdtemp(prefix="cellspark-prefix-")
    for name in ("PBMMC_1.csv", "HHD_1.csv", "other_notes.csv"):
        with open(os.path.join(d, name), "w") as f:
            f.write("gene,n\ng1,1\n")
    got = sorted((r.sample_id, r.sample_type, r.health_status) for r in IO.read_prefixed(spark, d, "PBMMC", ["ETV6", "HHD"]).collect())
    assert got == [("HHD_1", "HHD", "leukemia"), ("PBMMC_1", "healthy", "healthy")]
    with pytest.raises(ValueError):
        IO.read_prefixed(spark, d, "none", ["such"])


def test_string_drugs(spark):
    de = spark.createDataFrame([("g", f"gene{i}", float(9 - i), 1.0) for i in range(5)] + [("h", "gene9", 1.0, 1.0)],
                               "group string, gene_id string, score double, logfc double")
    drugs = spark.createDataFrame([("g", "aspirin", 0.1), ("g", "zinc", 0.01)], "group string, drug string, p_value double")
    got = {r.group: list(r.association.potential_drugs) for r in EN.drug_associations(de, drugs).collect()}
    assert got == {"g": ["zinc", "aspirin"], "h": []}


def test_neighbours_with_string_ids(spark):
    rng = np.random.default_rng(1)
    pts = rng.normal(size=(60, 4))
    pts[7] = pts[3]  # a tie, broken by id
    names = [f"S{i % 3}_c{i:02d}" for i in range(60)]
    df = spark.createDataFrame([(n, [float(x) for x in p]) for n, p in zip(names, pts)], "cell_id string, vec array<double>")

    def brute(q, refs, k):
        d = {r: float(np.sqrt(((pts[q] - pts[r]) ** 2).sum())) for r in refs if r != q}
        return [names[r] for r in sorted(d, key=lambda r: (d[r], names[r]))[:k]]

    got = {}
    for r in GR.knn(df, k=5, slab_size=10).orderBy("src", "rank").collect():  # several slabs
        got.setdefault(r.src, []).append(r.dst)
    assert got == {names[i]: brute(i, range(60), 5) for i in range(60)}
    near = {}
    for r in GR.knn(df, k=5, slab_size=10, method="slabs").collect():
        near.setdefault(r.src, set()).add(r.dst)
    recall = np.mean([len(near[n] & set(got[n])) / 5 for n in names])
    assert recall >= 0.5
    between = {}
    for r in GR.knn_to_reference(df.where("cell_id LIKE 'S0%'"), df.where("cell_id NOT LIKE 'S0%'"), k=4, block=7).orderBy("src", "rank").collect():
        between.setdefault(r.src, []).append(r.dst)
    refs = [i for i in range(60) if i % 3]
    assert between == {names[i]: brute(i, refs, 4) for i in range(0, 60, 3)}
    assert GR.knn(df.limit(1), k=3).collect() == []


def test_pseudotime_on_two_parts(spark):
    edges = [(a, b) for t in (0, 10) for a in range(t, t + 5) for b in range(t, t + 5) if abs(a - b) == 1]
    graph = spark.createDataFrame([(f"c{a}", f"c{b}", 1.0) for a, b in edges], "src string, dst string, weight double")
    got = {r.cell_id: r.dpt_pseudotime for r in GR.root_pseudotime(graph, "c0", n_comps=3).collect()}
    assert got["c0"] == 0 and max(got[f"c{i}"] for i in range(5)) == 1
    assert all(0 < got[f"c{i}"] <= 1 for i in range(1, 5))
    assert all(got[f"c{i}"] == float("inf") for i in range(10, 15))


def test_diagnostics_abort(spark):
    counts = spark.createDataFrame([(1, 1, 2.0)], "cell_id long, gene_id long, value double")
    cells = spark.createDataFrame([(1,), (2,)], "cell_id long")
    genes = spark.createDataFrame([(1,)], "gene_id long")
    with pytest.raises(ValueError, match="n_zero_cells"):
        QC.check_diagnostics(QC.diagnostics(counts, cells, genes))
    QC.check_diagnostics(QC.diagnostics(counts, cells.where("cell_id = 1"), genes))


def test_more_types_than_ten_thousand(spark):
    coef = spark.range(10_050).select(F.format_string("t%05d", "id").alias("type"), F.lit(1).alias("gene_id"), (F.col("id") / 1e6).alias("weight"))
    layer = spark.createDataFrame([(1, 1, 1.0)], "cell_id long, gene_id int, value double")
    cells = spark.createDataFrame([(1,)], "cell_id long")
    r = LB.classify_cells(layer, cells, coef).first()
    assert r.predicted_celltype == "t10049"


def test_crosstab_has_zeros(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), (None, "x")], "p string, q string")
    got = {(r.p, r.q): (r["count"], r.pct) for r in AG.crosstab(df, "p", "q", "index").collect()}
    assert got == {("a", "x"): (2, 100.0), ("a", "y"): (0, 0.0), ("b", "x"): (0, 0.0), ("b", "y"): (1, 100.0),
                   (None, "x"): (1, 100.0), (None, "y"): (0, 0.0)}
