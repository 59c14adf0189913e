"""Quality metrics, cell/gene filters and data checks (A1-A3, A10-A12, P5, P6,
P10, P12).

Every per-cell aggregate groups the long ``counts`` table by ``cell_id``; a
cell holds at most one row per gene, so no group is larger than the gene
count however many cells there are.  Per-gene aggregates use partial
(map-side) aggregation, so a gene present in every cell is combined before
the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PERCENT_TOP = (50, 100, 200, 500)


def _n_rows(df: DataFrame):
    """Row count of ``df`` as a scalar-subquery column (no action, no cross join)."""
    return df.select(F.count(F.lit(1))).scalar()


def qc_cells(counts: DataFrame, cells: DataFrame, genes: DataFrame | None = None,
             percent_top=PERCENT_TOP, mt_col: str = "is_mt") -> DataFrame:
    """Per-cell QC metrics joined onto ``cells`` (scanpy calculate_qc_metrics).

    Adds n_genes_by_counts (values > 0), total_counts, their log1p,
    pct_counts_in_top_{n}_genes and, when ``genes`` carries ``mt_col``,
    total_counts_mt / pct_counts_mt.  Cells without counts get zeros.
    """
    c = counts.where(F.col("value") > 0)
    aggs = [F.count(F.lit(1)).alias("n_genes_by_counts"),
            F.sum("value").alias("total_counts")]
    if percent_top:
        # rank inside one cell: at most n_genes rows per window partition
        w = Window.partitionBy("cell_id").orderBy(F.col("value").desc())
        c = c.withColumn("_rk", F.row_number().over(w))
        for n in percent_top:
            aggs.append(F.sum(F.when(F.col("_rk") <= n, F.col("value")).otherwise(0.0))
                        .alias(f"_top{n}"))
    if genes is not None and mt_col in genes.columns:
        mt = genes.where(F.col(mt_col)).select("gene_id", F.lit(True).alias("_mt"))
        c = c.join(mt, "gene_id", "left")
        aggs.append(F.sum(F.when(F.col("_mt"), F.col("value")).otherwise(0.0)).alias("total_counts_mt"))
    per_cell = c.groupBy("cell_id").agg(*aggs)
    out = cells.join(per_cell, "cell_id", "left")
    out = (out.withColumn("n_genes_by_counts", F.coalesce("n_genes_by_counts", F.lit(0)).cast("long"))
              .withColumn("total_counts", F.coalesce("total_counts", F.lit(0.0)).cast("double"))
              .withColumn("log1p_n_genes_by_counts", F.log1p("n_genes_by_counts"))
              .withColumn("log1p_total_counts", F.log1p("total_counts")))
    for n in percent_top or ():
        out = out.withColumn(
            f"pct_counts_in_top_{n}_genes",
            F.coalesce(F.try_divide(F.col(f"_top{n}") * 100.0, F.col("total_counts")), F.lit(0.0))
        ).drop(f"_top{n}")
    if "total_counts_mt" in out.columns:
        out = (out.withColumn("total_counts_mt", F.coalesce("total_counts_mt", F.lit(0.0)))
                  .withColumn("log1p_total_counts_mt", F.log1p("total_counts_mt"))
                  .withColumn("pct_counts_mt",
                              F.coalesce(F.try_divide(F.col("total_counts_mt") * 100.0,
                                                      F.col("total_counts")), F.lit(0.0))))
    return out


def pct_mt(counts: DataFrame, genes: DataFrame, cells: DataFrame, mt_col: str = "is_mt") -> DataFrame:
    """(cell_id, pct_counts_mt): mito share in percent, 0 when a cell has none."""
    q = qc_cells(counts, cells.select("cell_id"), genes, percent_top=(), mt_col=mt_col)
    return q.select("cell_id", "pct_counts_mt")


def flag_mito(genes: DataFrame, prefix: str = "MT-", symbol_col: str = "gene_symbol") -> DataFrame:
    """Mark mitochondrial genes by symbol prefix (the reference's rule)."""
    return genes.withColumn("is_mt", F.col(symbol_col).startswith(prefix))


def qc_genes(counts: DataFrame, genes: DataFrame, cells: DataFrame) -> DataFrame:
    """Per-gene QC: n_cells_by_counts, total_counts, mean_counts (zeros
    included), pct_dropout_by_counts, log1p's.  N comes from ``cells``."""
    n = _n_rows(cells)
    per_gene = (counts.where(F.col("value") > 0).groupBy("gene_id")
                .agg(F.count(F.lit(1)).alias("n_cells_by_counts"), F.sum("value").alias("total_counts")))
    out = genes.join(per_gene, "gene_id", "left")
    return (out.withColumn("n_cells_by_counts", F.coalesce("n_cells_by_counts", F.lit(0)).cast("long"))
               .withColumn("total_counts", F.coalesce("total_counts", F.lit(0.0)).cast("double"))
               .withColumn("mean_counts", F.col("total_counts") / n)
               .withColumn("log1p_mean_counts", F.log1p("mean_counts"))
               .withColumn("pct_dropout_by_counts", (F.lit(1.0) - F.col("n_cells_by_counts") / n) * 100.0)
               .withColumn("log1p_total_counts", F.log1p("total_counts")))


def filter_cells(cells_qc: DataFrame, min_genes: int | None = 200, max_counts: float | None = None,
                 max_genes: int | None = None, max_pct_mt: float | None = 20.0) -> DataFrame:
    """Keep cells passing every bound (all inclusive).  ``cells_qc`` comes
    from :func:`qc_cells`; the mito bound applies when pct_counts_mt exists."""
    cond = F.lit(True)
    if min_genes is not None:
        cond = cond & (F.col("n_genes_by_counts") >= min_genes)
    if max_counts is not None:
        cond = cond & (F.col("total_counts") <= max_counts)
    if max_genes is not None:
        cond = cond & (F.col("n_genes_by_counts") <= max_genes)
    if max_pct_mt is not None and "pct_counts_mt" in cells_qc.columns:
        cond = cond & (F.col("pct_counts_mt") <= max_pct_mt)
    return cells_qc.where(cond)


def restrict_counts(counts: DataFrame, cells: DataFrame | None = None,
                    genes: DataFrame | None = None) -> DataFrame:
    """Semi-join the long counts table to kept cells and/or genes."""
    out = counts
    if cells is not None:
        out = out.join(cells.select("cell_id"), "cell_id", "left_semi")
    if genes is not None:
        out = out.join(genes.select("gene_id"), "gene_id", "left_semi")
    return out


def filter_genes(counts: DataFrame, genes: DataFrame, min_cells: int = 3) -> DataFrame:
    """Genes expressed (value > 0) in at least ``min_cells`` cells of ``counts``
    -- pass the counts already restricted to the kept cells."""
    per_gene = (counts.where(F.col("value") > 0).groupBy("gene_id")
                .agg(F.count(F.lit(1)).alias("n_cells")))
    kept = per_gene.where(F.col("n_cells") >= min_cells)
    return genes.hint("merge").join(kept, "gene_id", "inner")  # ``kept`` is dealt by gene already


def validate(counts: DataFrame, cells: DataFrame, genes: DataFrame) -> dict:
    """Raise ValueError on an empty matrix; otherwise return its shape."""
    row = (counts.agg(F.count(F.lit(1)).alias("nnz"))
           .select("nnz", _n_rows(cells).alias("n_cells"), _n_rows(genes).alias("n_genes"))
           .first())
    if row["n_cells"] == 0:
        raise ValueError("No cells found")
    if row["n_genes"] == 0:
        raise ValueError("No genes found")
    return row.asDict()


def sparsity(counts: DataFrame, cells: DataFrame, genes: DataFrame) -> DataFrame:
    """One row: n_cells, n_genes, nnz, sparsity = 1 - nnz / (cells * genes)."""
    nnz = counts.where(F.col("value") != 0).agg(F.count(F.lit(1)).alias("nnz"))
    return nnz.select(_n_rows(cells).alias("n_cells"), _n_rows(genes).alias("n_genes"), "nnz",
                      (F.lit(1.0) - F.col("nnz") / (_n_rows(cells) * _n_rows(genes))).alias("sparsity"))


def diagnostics(counts: DataFrame, cells: DataFrame, genes: DataFrame) -> DataFrame:
    """One-row defect report of a (log-normalised) layer: NaN, Inf and
    negative entries, all-zero cells and genes, min / max / mean with zeros
    included (mean over n_cells * n_genes)."""
    v = F.col("value")
    stats = counts.agg(
        F.count_if(F.isnan(v)).alias("n_nan"),
        F.count_if(v.isin(float("inf"), float("-inf"))).alias("n_inf"),
        F.count_if(v < 0).alias("n_negative"),
        F.min(v).alias("_min_nz"), F.max(v).alias("_max_nz"),
        F.sum(v).alias("_sum"), F.count(F.lit(1)).alias("_nnz"))
    nz = counts.where(v != 0)
    zero_cells = cells.join(nz.select("cell_id"), "cell_id", "left_anti")
    zero_genes = genes.join(nz.select("gene_id"), "gene_id", "left_anti")
    total = _n_rows(cells) * _n_rows(genes)
    has_zero = F.col("_nnz") < total
    return stats.select(
        "n_nan", "n_inf", "n_negative",
        _n_rows(zero_cells).alias("n_zero_cells"),
        _n_rows(zero_genes).alias("n_zero_genes"),
        F.when(has_zero, F.least("_min_nz", F.lit(0.0))).otherwise(F.col("_min_nz")).alias("min_value"),
        F.when(has_zero, F.greatest("_max_nz", F.lit(0.0))).otherwise(F.col("_max_nz")).alias("max_value"),
        (F.col("_sum") / total).alias("mean_value"))


def check_diagnostics(report: DataFrame) -> None:
    """Abort (ValueError) if the diagnostics row shows any defect: NaN, infinite or
    negative entries, or cells or genes that are zero throughout."""
    r = report.first()
    bad = {k: r[k] for k in ("n_nan", "n_inf", "n_negative", "n_zero_cells", "n_zero_genes") if r[k]}
    if bad:
        raise ValueError(f"Data defects found: {bad}")


def before_after_report(cells_before: DataFrame, genes_before: DataFrame,
                        cells_after: DataFrame, genes_after: DataFrame) -> DataFrame:
    """Two rows (cells, genes): before, after, removed, pct_removed."""
    spark = cells_before.sparkSession

    def row(name, before, after):
        return (spark.range(1).select(
            F.lit(name).alias("axis"), _n_rows(before).alias("before"),
            _n_rows(after).alias("after")))
    out = row("cells", cells_before, cells_after).unionByName(row("genes", genes_before, genes_after))
    return (out.withColumn("removed", F.col("before") - F.col("after"))
               .withColumn("pct_removed",
                           F.coalesce(F.try_divide(F.col("removed") * 100.0, F.col("before")), F.lit(0.0))))
