"""Filtering and normalising as one written table."""

import math
import random

from cellspark.plans import pipeline as PL


def test_kept_counts_and_their_normalised_values_are_one_table(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(c, g, float(rng.randint(1, 9))) for c in range(30) for g in range(40) if rng.random() < (0.1 if c % 5 == 0 or g % 7 == 0 else 0.6)]
    counts = spark.createDataFrame(rows, "cell_id long, gene_id long, value double")
    cells = spark.createDataFrame([(c, str(c % 3)) for c in range(31)], "cell_id long, sample string")
    genes = spark.createDataFrame([(g, g % 11 == 0) for g in range(41)], "gene_id long, is_mt boolean")
    tables = []
    real = PL.materialize
    monkeypatch.setattr(PL, "materialize", lambda df: tables.append(df.columns) or real(df))
    f = PL.filter_and_normalize(counts, cells, genes, min_genes=12, min_cells=5, max_pct_mt=40.0)
    assert len(tables) == 3  # cells, genes, and both layers
    kept_cells = {r.cell_id for r in f.cells.collect()}
    kept_genes = {r.gene_id for r in f.genes.collect()}
    n = {c: sum(x[0] == c for x in rows) for c in range(31)}
    mt = {c: 100 * sum(x[2] for x in rows if x[0] == c and x[1] % 11 == 0) / max(1.0, sum(x[2] for x in rows if x[0] == c)) for c in range(31)}
    assert kept_cells == {c for c in range(31) if n[c] >= 12 and mt[c] <= 40} and 0 < len(kept_cells) < 30
    assert kept_genes == {g for g in range(41) if sum(x[1] == g and x[0] in kept_cells for x in rows) >= 5} and 0 < len(kept_genes) < 40
    want = {(c, g): v for c, g, v in rows if c in kept_cells and g in kept_genes}
    assert f.counts.columns == counts.columns and f.lognorm.columns == counts.columns
    assert {(r.cell_id, r.gene_id): r.value for r in f.counts.collect()} == want
    total = {c: sum(v for (d, _), v in want.items() if d == c) for c in kept_cells}
    got = {(r.cell_id, r.gene_id): r.value for r in f.lognorm.collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[k], math.log1p(v * 1e4 / total[k[0]])) for k, v in want.items())
    lazy = PL.filter_and_normalize(counts, cells, genes, min_genes=12, min_cells=5, max_pct_mt=40.0, checkpoint=False)
    assert sorted(lazy.counts.collect()) == sorted(f.counts.collect()) and len(tables) == 3
