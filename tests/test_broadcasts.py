"""Large cell and gene tables are joined by shuffles, whatever their files' size suggests."""

from cellspark.operators import de as DE
from cellspark.plans import pipeline as PL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _tables(spark, monkeypatch, bound):
    """Plans of the tables that the layers and the rank sums are written from."""
    rows = [(c, g, float(1 + (c * g) % 5)) for c in range(30) for g in range(20) if (c + g) % 3]
    counts = spark.createDataFrame(rows, "cell_id long, gene_id long, value double")
    cells = spark.createDataFrame([(c, "ab"[c % 2]) for c in range(30)], "cell_id long, sample_type string")
    genes = spark.createDataFrame([(g, g == 7) for g in range(20)], "gene_id long, is_mt boolean")
    plans, real = [], PL.materialize
    counts, cells, genes = real(counts), real(cells), real(genes)
    if bound is not None:
        monkeypatch.setattr(PL, "BROADCAST_BYTES", bound)
    for module in (PL, DE):
        monkeypatch.setattr(module, "materialize", lambda df: plans.append((df.columns, _plan(df))) or real(df))
    f = PL.filter_and_normalize(counts, cells, genes, min_genes=5, min_cells=3, max_pct_mt=None)
    found = DE.rank_genes(f.lognorm, f.cells, "sample_type", genes=f.genes.select("gene_id"))
    got = {(r.group, r.gene_id): round(r.score, 9) for r in found.collect()}
    return got, {"cells": plans[0], "genes": plans[1], "layers": plans[2], "entries": plans[3]}


def test_beyond_the_bound_no_cell_or_gene_table_is_broadcast(spark, monkeypatch):
    few, bounded = _tables(spark, monkeypatch, None)
    many, shuffled = _tables(spark, monkeypatch, 0)
    assert few == many and len(few) == 40
    for name in ("genes", "layers", "entries"):
        assert "BroadcastHashJoin" in bounded[name][1]
        assert "Broadcast" not in shuffled[name][1], (name, shuffled[name][1])
