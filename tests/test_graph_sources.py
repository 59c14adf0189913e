"""Graph operators against brute force; sources on fixtures written here."""

import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from cellspark.operators import graph as GR
from cellspark.sources import io as IO


def _vectors(spark, pts):
    return spark.createDataFrame([(int(i), [float(v) for v in p]) for i, p in enumerate(pts)],
                                 "cell_id long, vec array<double>")


def test_knn_exact_with_duplicates(spark):
    rng = np.random.default_rng(11)
    pts = rng.normal(size=(120, 5))
    pts[:40] = pts[0]                 # a heap of identical points (hot key)
    got = GR.knn(_vectors(spark, pts), k=6, slab_size=15).collect()
    by = {}
    for r in got:
        by.setdefault(r["src"], []).append((r["rank"], r["dst"], r["dist"]))
    assert len(by) == 120
    for i in range(120):
        d = np.sqrt(((pts - pts[i]) ** 2).sum(1))
        order = sorted((d[j], j) for j in range(120) if j != i)[:6]
        mine = [(dst, dist) for _, dst, dist in sorted(by[i])]
        assert [j for _, j in order] == [dst for dst, _ in mine]
        assert np.allclose([x for x, _ in order], [dist for _, dist in mine])


def test_connectivities_and_communities(spark):
    rng = np.random.default_rng(5)
    pts = np.vstack([rng.normal(0, 0.3, size=(30, 3)), rng.normal(5, 0.3, size=(30, 3))])
    edges = GR.knn(_vectors(spark, pts), k=5, slab_size=20)
    g = GR.connectivities(edges)
    w = {(r["src"], r["dst"]): r["weight"] for r in g.collect()}
    for (a, b), v in w.items():
        assert 0.0 <= v <= 1.0 + 1e-12
        assert abs(w[(b, a)] - v) < 1e-12        # symmetric
    com = GR.communities(g, resolution=1.0)
    labs = {r["cell_id"]: r["community"] for r in com.collect()}
    assert len(labs) == 60
    # the two well separated blobs never share a community
    assert not ({labs[i] for i in range(30)} & {labs[i] for i in range(30, 60)})
    singles = spark.createDataFrame([(i, str(i)) for i in range(60)], "cell_id long, community string")
    assert GR.modularity(g, com) >= GR.modularity(g, singles)


def test_read_mtx_and_bundle_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="cellspark-mtx-")
    for s, entries in (("S1", [(1, 1, 3), (2, 1, 1), (5, 2, 7), (3, 3, 2)]), ("S2", [(4, 1, 5)])):
        os.makedirs(os.path.join(d, s))
        with open(os.path.join(d, s, "matrix.mtx"), "w") as f:
            f.write("%%MatrixMarket matrix coordinate integer general\n%\n")
            f.write(f"5 3 {len(entries)}\n")
            for r, c, v in entries:
                f.write(f"{r} {c} {v}\n")
        with open(os.path.join(d, s, "barcodes.tsv"), "w") as f:
            f.write("AAAC-1\nAAAG-1\nAAAT-1\n")
        with open(os.path.join(d, s, "features.tsv"), "w") as f:
            for k in range(1, 6):
                f.write(f"ENSG{k}\tGENE{k}\tGene Expression\n")
    os.makedirs(os.path.join(d, "S3"))      # incomplete sample: skipped
    counts, cells, genes = IO.read_mtx_samples(spark, d)
    got = sorted((r["cell_id"], r["gene_id"], r["value"]) for r in counts.collect())
    assert got == [("S1_AAAC-1", "ENSG1", 3.0), ("S1_AAAC-1", "ENSG2", 1.0), ("S1_AAAG-1", "ENSG5", 7.0),
                   ("S1_AAAT-1", "ENSG3", 2.0), ("S2_AAAC-1", "ENSG4", 5.0)]
    assert cells.count() == 6 and genes.count() == 5
    out = tempfile.mkdtemp(prefix="cellspark-bundle-")
    IO.write_bundle(out, counts, cells, genes)
    c2, s2, g2 = IO.read_bundle(spark, out)
    assert c2.count() == 5 and s2.count() == 6 and g2.count() == 5
    assert c2.where(F.col("sample") == "S2").count() == 1


def test_detect_layout_and_dense(spark):
    d = tempfile.mkdtemp(prefix="cellspark-layout-")
    try:
        IO.detect_layout(spark, d)
        raise AssertionError("expected ValueError")
    except ValueError:
        pass
    p = os.path.join(d, "expression_matrix.csv")
    with open(p, "w") as f:
        f.write("cell,g1,g2\nc1,0,2\nc2,1,0\n")
    assert IO.detect_layout(spark, d) == "processed"
    long = sorted((r["cell_id"], r["gene_id"], r["value"]) for r in IO.read_dense_matrix(spark, p).collect())
    assert long == [("c1", "g2", 2.0), ("c2", "g1", 1.0)]
