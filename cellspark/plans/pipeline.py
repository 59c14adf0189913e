"""Compositions of operators: preprocessing (N6) and the end-to-end
analysis (E4).  Layers that many later steps read are materialised with a
reliable ``checkpoint()`` into the cluster's checkpoint folder, which both
cuts the lineage (an executor loss recomputes from the checkpoint, not from
the raw files) and keeps the logical plans of later steps small.
"""

from __future__ import annotations

import os
import time
import uuid
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import normalize as NZ
from ..operators import qc as QC
from ..session import checkpoint_dir, delete_path


#: Tables written in each open ``scratch`` block.
_open: list[list[str]] = []


class scratch:  # noqa: N801  used like a function
    """A block whose written tables are deleted when it ends; ``keep`` writes one that stays
    (with the enclosing block, if there is one).  What the block returns must be kept:

        with scratch(spark) as s:
            parts = materialize(...)
            return s.keep(parts.groupBy(...))
    """

    def __init__(self, spark) -> None:
        self.spark = spark

    def __enter__(self) -> scratch:
        _open.append([])
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        own = _open.pop()
        try:
            return materialize(df)
        finally:
            _open.append(own)

    def __exit__(self, *_) -> None:
        for path in _open.pop():
            delete_path(self.spark, path)


def tidy(operator):
    """An operator (DataFrame, ...) -> DataFrame whose result is a written table, and whose
    other written tables are deleted."""

    @wraps(operator)
    def run(first: DataFrame, *args, **kwargs) -> DataFrame:
        with scratch(first.sparkSession) as s:
            return s.keep(operator(first, *args, **kwargs))

    return run


def materialize(df: DataFrame, group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table under the cluster's checkpoint folder
    (``spark.checkpoint.dir``) and read it back.

    This cuts the lineage like a reliable ``checkpoint()`` (never
    ``localCheckpoint``): a lost executor recomputes nothing before this
    point.  A written table is used rather than ``Dataset.checkpoint``
    because the latter carries the original plan's metadata along, and in
    iterative loops (communities, diffusion) planning time then compounds
    with every round; a Parquet scan starts each round from a plain file
    source, computes the data once (checkpoint() computes it twice unless
    cached) and gives the optimizer real file statistics.

    ``group_bytes`` is for rows of a megabyte: Parquet's row groups end at about so many
    bytes, checked at every row, as a reader holds up to 4,096 rows of a group at once.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/table-{uuid.uuid4().hex}"
    t = time.time()
    if _open:
        _open[-1].append(path)
    writer = df.write.mode("errorifexists")
    if group_bytes:
        writer = writer.options(**{"parquet.block.size": str(group_bytes), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"})
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)  # given, the schema needs no job of its own
    if os.environ.get("CELLSPARK_DEBUG"):
        print(f"[materialize] {time.time() - t:.2f}s -> {path}", flush=True)
    return out


#: Bytes of rows, at ROW_BYTES each, up to which ``by_count`` broadcasts.
BROADCAST_BYTES, ROW_BYTES = 32 << 20, 64


def by_count(df: DataFrame) -> DataFrame:
    """``df`` (a written table, of a few plain columns) as the smaller side of a join: its rows are
    counted, and beyond the bound it is joined by a shuffle.  The planner would judge by the
    compressed files and the share of the columns read: 10 MB by that measure are millions
    of rows, whose hash table takes some 250 MB of the driver."""
    return F.broadcast(df) if df.count() * ROW_BYTES <= BROADCAST_BYTES else df.hint("merge")


@dataclass
class Filtered:
    cells: DataFrame       # kept cells with their QC columns
    genes: DataFrame       # kept genes with n_cells
    counts: DataFrame      # counts of kept cells and genes
    lognorm: DataFrame     # normalize_total + log1p of ``counts``


def filter_and_normalize(counts: DataFrame, cells: DataFrame, genes: DataFrame,
                         min_genes: int = 200, min_cells: int = 3, max_counts=None, max_genes=None,
                         max_pct_mt: float | None = 20.0, target_sum: float = 1e4,
                         percent_top=(), checkpoint: bool = True) -> Filtered:
    """QC -> P5 -> P6 -> N1 -> N2 (the first half of N6).  With ``checkpoint`` the genes are
    counted once, and the kept counts and their normalised values are one written table."""
    q = QC.qc_cells(counts, cells, genes, percent_top=percent_top)
    kept_cells = QC.filter_cells(q, min_genes, max_counts, max_genes, max_pct_mt)
    if checkpoint:
        kept_cells = materialize(kept_cells)
    of_cells = by_count(kept_cells.select("cell_id")) if checkpoint else kept_cells
    kept_genes = QC.filter_genes(QC.restrict_counts(counts, of_cells), genes, min_cells)
    if checkpoint:
        kept_genes = materialize(kept_genes)
    of_genes = by_count(kept_genes.select("gene_id")) if checkpoint else kept_genes
    # cells last: the totals of N1 are by cell too, so one shuffle serves both
    c2 = QC.restrict_counts(QC.restrict_counts(counts, genes=of_genes), of_cells)
    if not checkpoint:
        return Filtered(kept_cells, kept_genes, c2, NZ.lognorm(c2, target_sum))
    both = materialize(NZ.lognorm(c2.withColumn("_raw", F.col("value")), target_sum))
    c2 = both.select(*[F.col("_raw").alias("value") if c == "value" else c for c in c2.columns])
    return Filtered(kept_cells, kept_genes, c2, both.drop("_raw"))


@dataclass
class Preprocessed:
    filtered: Filtered
    hvg: DataFrame          # per gene: means, dispersions, ..., highly_variable
    scaled: DataFrame       # nonzero entries of the HVG layer, scaled
    gene_stats: DataFrame   # HVG: mean, std, zero_value


def preprocess(counts: DataFrame, cells: DataFrame, genes: DataFrame, min_genes: int = 200,
               min_cells: int = 3, n_top_genes: int = 2000, max_value: float = 10.0,
               target_sum: float = 1e4, max_pct_mt: float | None = 20.0,
               checkpoint: bool = True) -> Preprocessed:
    """QC -> filter cells -> filter genes -> normalise -> log1p -> keep the
    all-gene layer -> HVG (seurat) -> subset -> scale, in this order."""
    f = filter_and_normalize(counts, cells, genes, min_genes, min_cells, max_pct_mt=max_pct_mt,
                             target_sum=target_sum, checkpoint=checkpoint)
    hvg = NZ.highly_variable_genes(f.lognorm, f.cells, f.genes.select("gene_id"), n_top_genes)
    if checkpoint:
        hvg = materialize(hvg)
    sub = NZ.subset_genes(f.lognorm, hvg)
    if checkpoint:
        sub = materialize(sub)  # moments and scaled entries both read it
    scaled, stats = NZ.scale(sub, f.cells, max_value)
    stats = stats.join(hvg.where(F.col("highly_variable")).select("gene_id"), "gene_id", "left_semi")
    return Preprocessed(f, hvg, scaled, stats)


def analyze(counts: DataFrame, cells: DataFrame, genes: DataFrame, reference: tuple | None = None,
            gene_sets: DataFrame | None = None, signatures: DataFrame | None = None, model: tuple | None = None,
            root=None, min_genes: int = 200, min_cells: int = 3, target_sum: float = 1e4, n_top_genes: int = 2000,
            max_pct_mt: float | None = 20.0, n_pcs: int = 50, n_neighbors: int = 15, resolution: float = 0.5,
            knn_method: str = "exact", abnormal_ratio: float = 0.8, enrich_top: int = 100, drug_top: int = 50) -> dict:
    """The whole chain, as DataFrames in a dict.

    With ``reference`` (counts, cells, genes of healthy samples) both are aligned
    first (J2).  Then: filter, normalise, log, variable genes, scale (N6); abort on
    defects (P12); principal components (G1), neighbours (G3), weights (G4) and
    communities (G5); labels from ``model`` (coefficients, intercepts; L1) or by rule
    (L6); clusters that are mostly leukemia (R1); their genes against the healthy
    cells outside them (D2), or, without such clusters, every community against the rest
    (D1); enrichment, drugs and associations (E1-E3) when the tables are given; and
    pseudotime from ``root`` when one is given (G7, G8).

    The iterative steps run while the chain is built, each from written tables; the
    results are lazy.  Given labels are never overwritten (the reference
    re-clustered here, D-6): the cluster column is ``community``."""
    from ..operators import de as DE
    from ..operators import embed as EM
    from ..operators import enrich as EN
    from ..operators import graph as GR
    from ..operators import joins as JN
    from ..operators import labels as LB
    from ..operators import reference as RF
    if reference is not None:
        counts, cells, genes = JN.align_with_reference((counts, cells, genes), reference)
    pp = preprocess(counts, cells, genes, min_genes, min_cells, n_top_genes, target_sum=target_sum, max_pct_mt=max_pct_mt)
    f = pp.filtered
    QC.check_diagnostics(QC.diagnostics(f.lognorm, f.cells, f.genes))
    emb, _, _ = EM.pca(pp.scaled, pp.gene_stats, f.cells, n_pcs)
    emb = materialize(emb)
    edges = materialize(GR.knn(emb, k=n_neighbors - 1, method=knn_method))  # a cell counts among its own neighbours
    graph = materialize(GR.connectivities(edges))
    annotated = f.cells.join(GR.communities(graph, resolution), "cell_id", "left")
    if model is not None:
        found = LB.classify_cells(f.lognorm, f.cells, *model).withColumnRenamed("predicted_celltype", "cell_type")
        annotated = annotated.join(found.select("cell_id", "cell_type", "confidence"), "cell_id", "left")
    else:
        annotated = annotated.withColumn("cell_type", LB.rule_labels("community", "health_status"))
    annotated = materialize(annotated)
    clusters = materialize(RF.abnormal_clusters_ratio(annotated, "community", threshold=abnormal_ratio, type_col="cell_type"))
    abnormal = clusters.where("is_abnormal").select("community")
    tested = f.genes.select("gene_id")
    if not abnormal.isEmpty() and not annotated.where("health_status = 'healthy'").isEmpty():
        de = DE.rank_clusters_vs_healthy(f.lognorm, annotated, "community", abnormal, genes=tested)
    else:
        de = DE.rank_genes(f.lognorm, annotated, "community", genes=tested)
    de = materialize(de)
    out = {"cells": annotated, "genes": f.genes, "lognorm": f.lognorm, "hvg": pp.hvg, "embedding": emb, "graph": graph,
           "clusters": clusters, "de": de, "markers": DE.top_markers(DE.significant(de, flag="significant"), 10),
           "summary": DE.de_summary(de), "report": QC.before_after_report(cells, genes, f.cells, f.genes)}
    if gene_sets is not None:
        out["enrichment"] = EN.enrich(de, gene_sets, enrich_top)
    if signatures is not None:
        out["drugs"] = EN.rank_drugs(de, signatures, drug_top)
        out["associations"] = EN.drug_associations(de, out["drugs"])
    if root is not None:
        out["pseudotime"] = GR.root_pseudotime(graph, root)
    return out
